"""An ordered history of ALTER TABLE events, and rows judged by the rules that
held at their position (Q5, Q12, T10).

``Alter`` is one event of a table's change log; ``versions`` folds a history
into the specs that were valid one after the other. A row at position ``seq``
is judged by the checks valid then: a check added later does not touch it, one
that was dropped no longer applies, and one altered to NOT ENFORCED only
warns. All of it is one narrow pass over the rows, whatever their number; the
history itself is as small as the declarations.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltlake import spec as S
from siltlake.operators.changes import latest_state
from siltlake.operators.normalize import default_value
from siltlake.operators.quality import Rule, check_rules, rule_violations


@dataclass(frozen=True)
class Alter:
    """One event, valid from position ``at`` on: ``add_check`` (``check``),
    ``drop_check`` (``name``), ``alter_check`` (``name``, ``enforced``),
    ``add_column`` (``column``, with ``first`` or ``after``), ``drop_column`` (``name``)."""

    at: int
    kind: str
    check: S.Check | None = None
    name: str | None = None
    enforced: bool = True
    column: S.ColumnSpec | None = None
    first: bool = False
    after: str | None = None


def _altered(spec: S.TableSpec, event: Alter) -> S.TableSpec:
    checks, columns = {c.name: c for c in spec.checks}, list(spec.columns)
    names = [c.name for c in columns]
    if event.kind == "add_check":
        if event.check.name in checks:
            raise ValueError(f"{spec.name} has a check {event.check.name}")
        checks[event.check.name] = event.check
    elif event.kind in ("drop_check", "alter_check"):
        if event.name not in checks:
            raise ValueError(f"{spec.name} has no check {event.name}")
        if event.kind == "drop_check":
            del checks[event.name]
        else:
            checks[event.name] = replace(checks[event.name], enforced=event.enforced)
    elif event.kind == "add_column":
        if event.column.name in names:
            raise ValueError(f"{spec.name} has a column {event.column.name}")
        if event.after is not None and event.after not in names:
            raise ValueError(f"{spec.name} has no column {event.after}")
        columns.insert(0 if event.first else names.index(event.after) + 1 if event.after is not None else len(columns), event.column)
    elif event.kind == "drop_column":
        if event.name not in names:
            raise ValueError(f"{spec.name} has no column {event.name}")
        del columns[names.index(event.name)]
    else:
        raise ValueError(f"unknown event {event.kind}")
    return replace(spec, checks=tuple(checks.values()), columns=tuple(columns))


def versions(spec: S.TableSpec, events: list[Alter]) -> list[tuple[int | None, int | None, S.TableSpec]]:
    """``(from, to, spec)``: the spec valid for positions from <= seq < to, in
    order; None is open. Events of one position count together, as given."""
    out, start, current = [], None, spec
    ordered = sorted(events, key=lambda e: e.at)
    for k, event in enumerate(ordered):
        if k == 0 or ordered[k - 1].at != event.at:
            out.append((start, event.at, current))
            start = event.at
        current = _altered(current, event)
    return [*out, (start, None, current)]


def _within(seq: str, start: int | None, end: int | None):
    condition = F.lit(True)
    if start is not None:
        condition = condition & (F.col(seq) >= start)
    return condition if end is None else condition & (F.col(seq) < end)


def historic_violations(rows: DataFrame, spec: S.TableSpec, events: list[Alter], seq: str = "seq") -> DataFrame:
    """One row per row and check that it breaks, by the checks valid at its
    position; ``_rule`` and ``_severity`` as in ``check_violations``. The rows
    carry every column that their checks name."""
    spans: list[tuple] = []  # a check that several versions share is one rule
    for start, end, version in versions(spec, events):
        for check in version.checks:
            known = next((i for i, (c, _, e) in enumerate(spans) if c == check and e == start and start is not None), None)
            if known is None:
                spans.append((check, start, end))
            else:
                spans[known] = (check, spans[known][1], end)
    rules = []
    for check, start, end in spans:
        rule = check_rules([check])[0]
        rules.append(Rule(rule.name, _within(seq, start, end) & rule.violated, rule.severity))
    return rule_violations(rows, rules)


def historic_rows(rows: DataFrame, spec: S.TableSpec, events: list[Alter], seq: str = "seq") -> DataFrame:
    """The rows in the shape of the last version: its columns in its order,
    ``seq`` in front if it is none of them. A row from before an ADD COLUMN has
    the column's default; later ones what they carry (NULL if the rows lack it)."""
    last = versions(spec, events)[-1][2]
    added = {e.column.name: e for e in sorted(events, key=lambda e: e.at) if e.kind == "add_column"}
    out = [] if seq in last.column_names else [F.col(seq)]
    for c in last.columns:
        own = F.col(c.name) if c.name in rows.columns else F.lit(None)
        if c.name in added:
            old = default_value(c)
            own = F.when(F.col(seq) < added[c.name].at, old).otherwise(own if c.name in rows.columns else F.lit(None).cast(S.spark_type(c)))
        out.append(own.alias(c.name))
    return rows.select(*out)


def blocking_rows(changes: DataFrame, events: list[Alter], key: str | list[str] = "pk", seq: str = "seq", op: str = "op") -> DataFrame:
    """Rows that stood in the table when a check was added or altered to
    ENFORCED and that break it (Q12): the change's row, ``_rule`` and ``_at``,
    the position of the ALTER that they block. The state of that moment is the
    last change of each key before it."""
    checks: dict[str, S.Check] = {}
    out = None
    for event in sorted(events, key=lambda e: e.at):
        if event.kind == "add_check":
            checks[event.check.name] = event.check
            judged = event.check if event.check.enforced else None
        elif event.kind == "alter_check" and event.name in checks:
            judged = replace(checks[event.name], enforced=True) if event.enforced else None
        else:
            continue
        if judged is not None:
            state = latest_state(changes.where(F.col(seq) < event.at), key, seq, op)
            found = rule_violations(state, check_rules([judged])).drop("_severity").withColumn("_at", F.lit(event.at).cast("long"))
            out = found if out is None else out.unionByName(found)
    if out is None:
        out = changes.withColumn("_rule", F.lit("")).withColumn("_at", F.lit(0).cast("long")).where(F.lit(False))
    return out
