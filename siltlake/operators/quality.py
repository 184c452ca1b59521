"""Declared constraints applied to dirty data: report, never reject.

Row-local rules (NOT NULL, ENUM/SET domain, integer range, length, CHECK)
are Column predicates evaluated in one projection. Key rules (UNIQUE,
PRIMARY KEY) are one aggregate each; references (FOREIGN KEY) are one anti
join on keys only per NULL pattern.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from siltlake import spec as S
from siltlake.functions.columns import all_null, any_null, int_lit, key_part_col, key_part_name


@dataclass(frozen=True)
class Rule:
    name: str
    violated: Column          # TRUE when the row breaks the rule (never NULL)
    severity: str = "error"   # error | warning (NOT ENFORCED checks)


# --------------------------------------------------------------------------
# Row-local rules from a spec
# --------------------------------------------------------------------------

def _num(c: Column) -> Column:
    return c.cast("string").try_cast("decimal(38,0)")


def not_null_rules(spec: S.TableSpec, df: DataFrame) -> list[Rule]:
    return [Rule(f"not_null:{c.name}", F.col(c.name).isNull()) for c in spec.columns
            if not c.nullable and c.name in df.columns]


def domain_rules(spec: S.TableSpec, df: DataFrame) -> list[Rule]:
    out = []
    for c in spec.columns:
        if c.name not in df.columns or not c.members:
            continue
        x = F.col(c.name)
        if c.kind == "enum":
            out.append(Rule(f"enum:{c.name}", F.coalesce(x.isNotNull() & ~x.isin(*c.members), F.lit(False))))
        elif c.kind == "set":
            # '' is the empty set, as in loosen
            arr = x if df.schema[c.name].dataType.typeName() == "array" else F.when(
                x == "", F.array().cast("array<string>")).otherwise(F.split(x, ","))
            bad = F.size(F.array_except(arr, F.array(*[F.lit(m) for m in c.members]))) > 0
            out.append(Rule(f"set:{c.name}", F.coalesce(x.isNotNull() & bad, F.lit(False))))
    return out


def range_rules(spec: S.TableSpec, df: DataFrame) -> list[Rule]:
    out = []
    for c in spec.columns:
        if c.name not in df.columns:
            continue
        if c.kind in S.INTEGER_TYPES:
            lo, hi = (0, S.UNSIGNED_MAX[c.kind]) if c.unsigned else S.SIGNED_RANGE[c.kind]
        elif c.kind == "bit":
            lo, hi = 0, 2 ** (c.length or 1) - 1
        else:
            continue
        v = _num(F.col(c.name))
        bad = v.isNotNull() & ((v < int_lit(lo)) | (v > int_lit(hi)))
        out.append(Rule(f"range:{c.name}", F.coalesce(bad, F.lit(False))))
    return out


def length_rules(spec: S.TableSpec, df: DataFrame) -> list[Rule]:
    out = []
    for c in spec.columns:
        if c.name not in df.columns or c.length is None:
            continue
        if c.kind in S.TEXT_TYPES:
            n = F.length(F.col(c.name).cast("string"))
        elif c.kind in S.BINARY_TYPES:
            n = F.octet_length(F.col(c.name))
        else:
            continue
        out.append(Rule(f"length:{c.name}", F.coalesce(n > c.length, F.lit(False))))
    return out


def check_rules(checks: list[S.Check] | tuple) -> list[Rule]:
    """CHECK: violated when the rule is FALSE; NULL passes. NOT ENFORCED
    checks are reported as warnings and never quarantine a row."""
    return [Rule(f"check:{ch.name}", F.coalesce(~F.expr(ch.rule), F.lit(False)),
                 "error" if ch.enforced else "warning") for ch in checks]


def row_rules(spec: S.TableSpec, df: DataFrame) -> list[Rule]:
    return (not_null_rules(spec, df) + domain_rules(spec, df) + range_rules(spec, df)
            + length_rules(spec, df) + check_rules(spec.checks))


def rule_violations(df: DataFrame, rules: list[Rule], rule_col: str = "_rule") -> DataFrame:
    """One row per (row, broken rule): the row's columns plus the rule name
    and severity. One narrow pass over the input."""
    if not rules:
        return df.withColumn(rule_col, F.lit(None).cast("string")).withColumn(
            "_severity", F.lit(None).cast("string")).where(F.lit(False))
    any_bad = reduce(lambda a, b: a | b, [r.violated for r in rules])
    tags = F.array(*[F.when(r.violated, F.struct(F.lit(r.name).alias("rule"), F.lit(r.severity).alias("severity")))
                     for r in rules])
    x = df.where(any_bad).withColumn("_t", F.explode(tags)).where(F.col("_t").isNotNull())
    return x.withColumn(rule_col, F.col("_t.rule")).withColumn("_severity", F.col("_t.severity")).drop("_t")


def not_null_violations(df: DataFrame, spec: S.TableSpec) -> DataFrame:
    return rule_violations(df, not_null_rules(spec, df))


def domain_violations(df: DataFrame, spec: S.TableSpec) -> DataFrame:
    """ENUM: value not a member; SET: some element not a member (Q6).

    Domains come from the spec (bounded by what the user declared); a very
    large domain is better checked with :func:`domain_violations_join`."""
    return rule_violations(df, domain_rules(spec, df))


def domain_violations_join(df: DataFrame, column: str, members: DataFrame, is_set: bool = False) -> DataFrame:
    """Large domains as a DataFrame of allowed values (column ``member``):
    anti join instead of an inline list. For SET, rows are exploded, checked
    and the offending original rows returned once."""
    m = members.select(F.col("member")).distinct()
    if not is_set:
        return df.where(F.col(column).isNotNull()).join(m, F.col(column) == m["member"], "left_anti")
    # the distinct SET texts are judged, not the rows: fewer rows, and no row ids
    texts = df.where(F.col(column).isNotNull()).select(F.col(column).alias("_text")).distinct()
    elements = F.when(F.col("_text") == "", F.array().cast("array<string>")).otherwise(F.split("_text", ","))  # '' = empty set
    bad = texts.select("_text", F.explode(elements).alias("_el")).join(m, F.col("_el") == m["member"], "left_anti").select("_text").distinct()
    return df.join(bad, df[column] == bad["_text"], "left_semi")


def range_violations(df: DataFrame, spec: S.TableSpec) -> DataFrame:
    return rule_violations(df, range_rules(spec, df))


def length_violations(df: DataFrame, spec: S.TableSpec) -> DataFrame:
    return rule_violations(df, length_rules(spec, df))


def check_violations(df: DataFrame, checks: list[S.Check] | tuple) -> DataFrame:
    return rule_violations(df, check_rules(checks))


# --------------------------------------------------------------------------
# Key rules (Q2, Q3)
# --------------------------------------------------------------------------

def _key_cols(parts) -> tuple[list[Column], list[str]]:
    parts = S.key_columns(parts)
    names = [key_part_name(p, i) for i, p in enumerate(parts)]
    return [key_part_col(p).alias(n) for p, n in zip(parts, names)], names


def unique_violations(df: DataFrame, parts, rows: bool = False) -> DataFrame:
    """Keys (all parts non-null; NULLs never collide) held by more than one
    row (Q2): ``(key…, n_rows)``; with ``rows=True`` the offending rows.

    One partial+final aggregate on the key: a hot key is pre-counted per task
    before the shuffle. The way back to rows is a join on the (usually small)
    duplicate-key table, which AQE broadcasts when its measured size allows
    and otherwise splits skewed partitions."""
    kcols, names = _key_cols(parts)
    keyed = df.select(*kcols)
    dup = keyed.where(~any_null([F.col(n) for n in names])).groupBy(*names).agg(
        F.count(F.lit(1)).alias("n_rows")).where(F.col("n_rows") > 1)
    if not rows:
        return dup
    extra = [c for c, n in zip(kcols, names) if n not in df.columns]
    return df.select("*", *extra).join(dup, names, "inner")


def primary_key_violations(df: DataFrame, parts) -> DataFrame:
    """PRIMARY KEY = NOT NULL on every part + UNIQUE (Q3), in one aggregate:
    ``(key…, reason, n_rows)`` with reason ``null_part`` or ``duplicate``."""
    kcols, names = _key_cols(parts)
    g = df.select(*kcols).groupBy(*names).agg(F.count(F.lit(1)).alias("n_rows"))
    reason = F.when(any_null([F.col(n) for n in names]), F.lit("null_part")).when(
        F.col("n_rows") > 1, F.lit("duplicate"))
    return g.withColumn("reason", reason).where(F.col("reason").isNotNull()).select(*names, "reason", "n_rows")


# --------------------------------------------------------------------------
# References
# --------------------------------------------------------------------------

def fk_violations(child: DataFrame, parent: DataFrame, columns: list[str] | tuple, parent_parts,
                  match: str = "SIMPLE") -> DataFrame:
    """Child rows with no parent under the MATCH rule.

    * SIMPLE: any NULL part -> passes; else the full key must exist.
    * FULL: all parts NULL -> passes; some NULL -> violation; none -> must exist.
    * PARTIAL: all NULL -> passes; otherwise the non-null parts must match
      some parent row on those parts.

    Each rule is one anti join, so the child is scanned once and keeps its
    rows (bag semantics); the parent is reduced to distinct key tuples first
    (H6). FULL needs no second pass: a row with some NULL part can never
    equal a parent key, so the anti join keeps it by itself. PARTIAL tags
    every child row with its NULL pattern (exactly one per row) and expands
    each parent row into its 2^k - 1 non-empty sub-keys (NULL in the unused
    positions); pattern and sub-key then match with null-safe equality."""
    parts = S.key_columns(parent_parts)
    cols = list(columns)
    k = len(cols)
    pnames = [f"_p{i}" for i in range(k)]
    pkeys = parent.select(*[key_part_col(p).alias(n) for p, n in zip(parts, pnames)])

    def child_key(i: int) -> Column:
        p = parts[i]
        c = F.col(cols[i])
        return F.substring(c.cast("string"), 1, p.prefix) if p.prefix else c

    match = match.upper()
    if match in ("SIMPLE", "FULL"):
        keep = ~any_null([F.col(c) for c in cols]) if match == "SIMPLE" else ~all_null([F.col(c) for c in cols])
        pk = pkeys.where(~any_null([F.col(n) for n in pnames])).distinct()
        cond = reduce(lambda a, b: a & b, [child_key(i) == pk[pnames[i]] for i in range(k)])
        return child.where(keep).join(pk, cond, "left_anti")
    if match != "PARTIAL":
        raise ValueError(f"unknown MATCH {match}")
    bit = [F.when(F.col(c).isNotNull(), F.lit(1 << i)).otherwise(F.lit(0)) for i, c in enumerate(cols)]
    tagged = child.withColumn("_pat", reduce(lambda a, b: a + b, bit)).where(F.col("_pat") > 0)
    subsets = []
    for m in range(1, 1 << k):
        used = [i for i in range(k) if m >> i & 1]
        ok = ~any_null([F.col(pnames[i]) for i in used])
        subsets.append(F.when(ok, F.struct(F.lit(m).alias("_m"), *[
            (F.col(pnames[i]) if i in used else F.lit(None).cast(pkeys.schema[pnames[i]].dataType)).alias(f"_v{i}")
            for i in range(k)])))
    expanded = pkeys.select(F.explode(F.array(*subsets)).alias("_e")).where(F.col("_e").isNotNull()).select(
        "_e.*").distinct()
    cond = (tagged["_pat"] == expanded["_m"]) & reduce(
        lambda a, b: a & b, [child_key(i).eqNullSafe(expanded[f"_v{i}"]) for i in range(k)])
    return tagged.join(expanded, cond, "left_anti").drop("_pat")


# --------------------------------------------------------------------------
# Q9 report, Q10 split, Q12 pre-check
# --------------------------------------------------------------------------

def quality_report(df: DataFrame, spec: S.TableSpec, parents: dict[str, DataFrame] | None = None,
                   sample_key: str | None = None) -> DataFrame:
    """Long table ``(rule, severity, violations, n_rows, sample_key)``.

    All row-local rules are conditional sums in **one** aggregate; each key
    rule is one aggregate; each FK one anti join. ``sample_key`` is the
    smallest offending key in the key's own order (deterministic), shown as
    text. It stays typed through every aggregate, so a numeric key keeps
    them hash-based; it becomes text only in the few-row result."""
    key = sample_key or (spec.primary_key[0].column if spec.primary_key else df.columns[0])
    kc = F.col(key)
    ktype = df.schema[key].dataType
    rules = row_rules(spec, df)
    fks = [fk for fk in spec.foreign_keys if parents is not None and fk.parent in parents]
    parts = []
    # one aggregate for every row-local rule; it also supplies the row count
    # of the FK rules (their anti joins only count violations)
    aggs = [F.count(F.lit(1)).alias("_rows")]
    for i, r in enumerate(rules):
        aggs += [F.sum(r.violated.cast("bigint")).alias(f"_v{i}"), F.min(F.when(r.violated, kc)).alias(f"_s{i}")]
    one = df.agg(*aggs)
    items = [F.struct(F.lit(r.name).alias("rule"), F.lit(r.severity).alias("severity"),
                      F.coalesce(F.col(f"_v{i}"), F.lit(0)).cast("bigint").alias("violations"),
                      F.col(f"_s{i}").alias("sample_key")) for i, r in enumerate(rules)]
    items += [F.struct(F.lit(f"fk:{fk.name}").alias("rule"), F.lit("error").alias("severity"),
                       F.lit(None).cast("bigint").alias("violations"), F.lit(None).cast(ktype).alias("sample_key"))
              for fk in fks]
    if items:
        parts.append(one.select(F.col("_rows").cast("bigint").alias("n_rows"), F.explode(F.array(*items)).alias("_r"))
                     .select("_r.rule", "_r.severity", "_r.violations", "n_rows", "_r.sample_key"))
    key_rules = []
    if spec.primary_key:
        key_rules.append(("primary_key", spec.primary_key, True))
    for uk in spec.unique_keys:
        key_rules.append(("unique:" + ",".join(p.label for p in uk), uk, False))
    for name, uk, is_pk in key_rules:
        kcols, names = _key_cols(uk)
        g = df.select(*kcols, kc.alias("_sk")).groupBy(*names).agg(
            F.count(F.lit(1)).alias("_n"), F.min("_sk").alias("_sk"))
        nulls = any_null([F.col(n) for n in names])
        bad = (nulls if is_pk else F.lit(False)) | (~nulls & (F.col("_n") > 1))
        parts.append(g.agg(
            F.lit(name).alias("rule"), F.lit("error").alias("severity"),
            F.coalesce(F.sum(F.when(bad, F.col("_n"))), F.lit(0)).cast("bigint").alias("violations"),
            F.sum("_n").cast("bigint").alias("n_rows"), F.min(F.when(bad, F.col("_sk"))).alias("sample_key")))
    for fk in fks:
        v = fk_violations(df, parents[fk.parent], fk.columns, fk.parent_columns, fk.match)
        parts.append(v.agg(F.lit(f"fk:{fk.name}").alias("rule"), F.lit("error").alias("severity"),
                           F.count(F.lit(1)).cast("bigint").alias("violations"),
                           F.lit(None).cast("bigint").alias("n_rows"), F.min(kc).alias("sample_key")))
    if not parts:
        parts.append(one.select(F.lit("rows").alias("rule"), F.lit("info").alias("severity"),
                                F.lit(0).cast("bigint").alias("violations"),
                                F.col("_rows").cast("bigint").alias("n_rows"),
                                F.lit(None).cast(ktype).alias("sample_key")))
    report = reduce(lambda a, b: a.unionByName(b), parts)
    # at most two rows per rule (FK: violations + row count): merge them
    return report.groupBy("rule", "severity").agg(
        F.max("violations").alias("violations"), F.max("n_rows").alias("n_rows"),
        F.min("sample_key").cast("string").alias("sample_key"))


def split_clean(df: DataFrame, spec: S.TableSpec, reasons: str = "_reasons") -> tuple[DataFrame, DataFrame]:
    """Row-local rules only (Q10): ``(clean, quarantine)``; quarantine rows
    carry ``_reasons ARRAY<STRING>``. Warnings never quarantine. Every input
    row lands in exactly one of the two."""
    errs = [r for r in row_rules(spec, df) if r.severity == "error"]
    tagged = df.withColumn(reasons, F.array_compact(F.array(*[F.when(r.violated, F.lit(r.name)) for r in errs]))
                           if errs else F.array().cast("array<string>"))
    clean = tagged.where(F.size(reasons) == 0).drop(reasons)
    quarantine = tagged.where(F.size(reasons) > 0)
    return clean, quarantine


def rule_holds(df: DataFrame, kind: str, **kw) -> DataFrame:
    """Rows (or keys) that break a rule about to be added with ALTER … ADD
    (Q12). ``kind``: primary_key | unique | foreign_key | check. Empty result
    means the rule holds (test with ``.isEmpty()``: one bounded action)."""
    if kind == "primary_key":
        return primary_key_violations(df, kw["parts"])
    if kind == "unique":
        return unique_violations(df, kw["parts"])
    if kind == "foreign_key":
        return fk_violations(df, kw["parent"], kw["columns"], kw["parent_parts"], kw.get("match", "SIMPLE"))
    if kind == "check":
        return check_violations(df, [S.Check(kw.get("name", "new_check"), kw["rule"])])
    raise ValueError(kind)
