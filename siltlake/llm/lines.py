"""Line dedup across all documents: exact repeats, and lines within a few edits.

Only built-in DataFrame functions are used. A line of at least ``min_chars``
characters is judged. A line goes if an equal line
comes before it (by document id, then place), or if its first occurrence comes
after that of a line within the edits that the shorter of the two allows: one
up to 49 characters, two from 50, and one more with each doubling (100, 200,
400, ...); or ``max_edits`` for every length, if given.
A shorter line that is not blank goes only as an exact repeat, and only with
``short_repeats``: if it stands that often or more over all documents, all but
its first place go. Blank lines always stay.

Near lines are found by a segment-partition edit join, by classes of lengths
that double. In a class of t edits a line has t + 1 segments of one size, the
first half of them placed from the line's start, the others from its end. Of
t + 1 separate segments one is untouched with exactly as many edits before it
as segments, so a later line looks for segment k at most k places off if it is
placed from the start, at most t - k if from the end. A line whose partner may
lie in the class below has keys there too. What meets is verified with a banded
bit-parallel edit distance of the parts between equal ends: one machine word
holds the band of a column, one step of ``aggregate`` goes to the next; pairs
whose parts Spark's own thresholded distance rejects are not looked at.

One near earlier line is enough to settle a line, so a group of near lines is
not paired with itself. A key is first reduced to its earliest line and how
many it has; a later line with that key is paired with that one line only, so
this step is linear. Of a line's pairs the one with most keys in common is
verified first, the others only if that fails. Lines still open whose keys
have further earlier lines look for these in a semi join that holds the whole
check: both must agree in length and in a fingerprint, 512 parities of 4-gram
hashes of which an edit turns at most eight, then in distance; lines of several
keys are compared by one of them. It writes a line at most once a key and no
pairs, however large a group of near lines is.

Keys are made once: what a later line looks for holds its own segments too, so
one shuffle by key serves both sides, and only rows of keys that bring lines
together are written. A key row is a 64-bit hash and the line's number; first
occurrences are numbered in the order of their places, so that the earliest is
a minimum of plain numbers. Texts are shuffled whole by document id, once to
make the keys of first occurrences and once for the result, and only texts of
lines that met a key go on to the verification.

Defined results: a null text stays null, an empty text stays empty; documents
with one id count as one place, so a line that both hold at the same place
stays in both; repeated lines inside a document go like any other; an empty
table gives no rows; other columns are kept, whatever their names.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from siltlake.session import checkpoint_dir

MIN_CHARS = 30
#: a shorter line may differ in one edit, one of this length in two, and each doubling allows one more
TWO_EDITS = 50
#: places of lines that met a key: up to this number (some 50 bytes each) they are sent to every task
BROADCAST_LINES = 500_000
#: the fingerprint of a line: words of 64 parities, of grams of some bytes
_WORDS, _GRAM = 8, 4
_SEP = "\n"


def _bind(value: Column, use) -> Column:
    """``use`` of a value that is computed once, however often it is used."""
    return F.transform(F.array(value), use)[0]


def edit_distance_within(a: Column, b: Column, limit: int) -> Column:
    """Edits between two texts of at least ``limit`` characters if these are
    at most ``limit``, else any larger number. Bit k of a word stands for row
    ``column - limit + k``; the score follows the band's lower edge down to
    the last row and then that row to the last column."""
    width, top = 2 * limit + 1, 2 * limit
    full = F.lit((1 << width) - 1).cast("long")

    def codes(c: Column) -> Column:
        return F.transform(F.split(c, ""), lambda x: F.ascii(x))

    def matches(rows: Column, x: Column, j: Column) -> Column:
        bits = [F.when(F.get(rows, j + (k - limit - 1)) == x, F.lit(1 << k)).otherwise(0) for k in range(width)]
        return sum(bits[1:], bits[0]).cast("long")

    def bit(word: Column, k) -> Column:
        return F.shiftright(word, k).bitwiseAND(F.lit(1))

    def next_column(n: Column):
        def step(acc: Column, col: Column) -> Column:
            vp, vn, x, j = acc["vp"], acc["vn"], col["x"], col["j"]

            def rest(d: Column) -> Column:  # d: the diagonal word
                hp = vn.bitwiseOR(F.bitwise_not(d.bitwiseOR(vp))).bitwiseAND(full)
                hn, down, at = d.bitwiseAND(vp), F.shiftright(d, 1), n - j + limit
                last = [F.when(at == k, bit(hp, k) - bit(hn, k)) for k in range(top + 1)]
                score = F.when(j <= n - limit, 1 - bit(d, top)).otherwise(F.coalesce(*last, F.lit(0)))
                return F.struct(hn.bitwiseOR(F.bitwise_not(down.bitwiseOR(hp))).bitwiseAND(full).alias("vp"),
                                down.bitwiseAND(hp).alias("vn"), (acc["dist"] + score).cast("long").alias("dist"))
            return _bind((x.bitwiseAND(vp) + vp).bitwiseXOR(vp).bitwiseOR(x).bitwiseOR(vn).bitwiseAND(full), rest)
        return step

    start = F.struct(F.lit(((1 << limit + 1) - 1) << limit).cast("long").alias("vp"), F.lit(0).cast("long").alias("vn"),
                     F.lit(limit).cast("long").alias("dist"))

    def score(p: Column) -> Column:
        columns = F.transform(p["c"], lambda x, i: F.struct((i + 1).alias("j"), matches(p["r"], x, i + 1).alias("x")))
        found = F.aggregate(columns, start, next_column(p["n"]), lambda acc: acc["dist"])
        return F.when(F.abs(p["n"] - F.size(p["c"])) > limit, F.lit(limit + 1).cast("long")).otherwise(found)

    return _bind(F.struct(codes(a).alias("r"), codes(b).alias("c"), F.length(a).alias("n")), score)


def _common(a: Column, b: Column, piece) -> Column:
    """The largest n with ``piece(a, n) = piece(b, n)``, by bisection."""
    size = F.least(F.length(a), F.length(b))
    start = F.struct(F.lit(0).alias("lo"), size.alias("hi"))

    def halve(acc: Column, _: Column) -> Column:
        mid = ((acc["lo"] + acc["hi"] + 1) / 2).cast("int")
        return _bind(mid, lambda m: F.when(piece(a, m) == piece(b, m), F.struct(m.alias("lo"), acc["hi"].alias("hi")))
                     .otherwise(F.struct(acc["lo"].alias("lo"), F.greatest(m - 1, acc["lo"]).alias("hi"))))

    steps = F.sequence(F.lit(0), F.ceil(F.log2(size + 2)).cast("int"))
    return F.aggregate(steps, start, halve, lambda acc: acc["lo"])


def differing_middles(a: Column, b: Column, limit: int | Column) -> Column:
    """``struct(a, b)``: both texts cut to where they differ (edits keep what
    is equal at both ends), leaving enough on either side for the band."""
    def texts(x: Column, y: Column) -> Column:
        return F.struct(x.alias("a"), y.alias("b"))

    def cut(p: Column, piece, rest) -> Column:
        n = F.greatest(_common(p["a"], p["b"], piece) - (limit + 1), F.lit(0))
        return _bind(n, lambda k: texts(rest(p["a"], k), rest(p["b"], k)))

    tails = _bind(texts(a, b), lambda p: cut(p, lambda c, n: F.substring(c, F.lit(1), n), lambda c, k: F.substring(c, k + 1, F.length(c))))
    return _bind(tails, lambda p: cut(p, lambda c, n: F.right(c, n), lambda c, k: F.substring(c, F.lit(1), F.length(c) - k)))


def _level(n: Column, max_edits: int | None, min_chars: int) -> Column:
    """The number of the class of a line of n >= ``min_chars`` characters: classes double in length."""
    def bits(base: int) -> Column:  # of a whole number: exact, where a logarithm is not
        return F.length(F.bin(F.floor(n / base)))

    if max_edits is not None:
        return bits(max(1, min_chars)) - 1
    return F.when(n < TWO_EDITS, F.lit(0)).otherwise(bits(TWO_EDITS))


def _class(level: Column, max_edits: int | None, min_chars: int) -> Column:
    """``struct(lo, edits)`` of a class: where its lengths begin, and the edits that it allows."""
    def entry(lo: Column, edits: Column) -> Column:
        return F.struct(lo.cast("int").alias("lo"), edits.cast("int").alias("edits"))

    if max_edits is not None:
        return entry(F.lit(max(1, min_chars)) * F.pow(F.lit(2), level), F.lit(max_edits))
    lo = F.when(level == 0, F.lit(max(2, min_chars))).otherwise(F.lit(TWO_EDITS) * F.pow(F.lit(2), level - 1))
    return entry(lo, level + 1)


def allowed_edits(n: Column, max_edits: int | None, min_chars: int) -> Column:
    """The edits that a line of n >= ``min_chars`` characters allows; a longer one allows no fewer."""
    return _class(_level(n, max_edits, min_chars), max_edits, min_chars)["edits"]


def in_classes(lines: DataFrame, max_edits: int | None, min_chars: int) -> DataFrame:
    """``lines`` (``_n``) once for each class ``_c`` in which they may have a partner that is no longer."""
    n = F.col("_n")
    shortest = F.greatest(n - allowed_edits(n, max_edits, min_chars), F.lit(max(1, min_chars)))
    levels = F.sequence(_level(F.col("_m"), max_edits, min_chars), _level(n, max_edits, min_chars))
    return (lines.withColumn("_m", shortest).where("_m <= _n").select(*lines.columns, F.explode(levels).alias("_level"))
            .select(*lines.columns, _class(F.col("_level"), max_edits, min_chars).alias("_c")))


def single_bytes(line: Column) -> Column:
    """A line as one byte a character, so that its parts are cut without
    counting characters; what has no such byte is one and the same."""
    others = F.encode(F.regexp_replace(line, r"[^\x00-\xFF]", "?"), "ISO-8859-1")
    return F.when(F.octet_length(line) == F.length(line), line.cast("binary")).otherwise(others)


def segment_keys(lines: DataFrame) -> DataFrame:
    """``(_as, _key)`` of each substring of the lines (``_no``, ``_flat``,
    ``_n``, class ``_c``) that may be a segment of an earlier line; ``_as`` is
    twice the line's number, and one more if the segment is the line's own."""
    lo, edits, k, off = F.col("_c.lo"), F.col("_c.edits"), F.col("_k"), F.col("_off")
    most = F.when(k * 2 <= edits, k).otherwise(edits - k)
    size = F.floor(lo / (edits + 1)).cast("int")
    cut = lines.select("*", F.explode(F.sequence(F.lit(0), edits)).alias("_k"))
    cut = cut.select("*", F.explode(F.sequence(-most, most)).alias("_off"))
    start = F.when(k * 2 <= edits, k * size).otherwise(F.col("_n") - (edits + 1 - k) * size) + off
    return (cut.where((start >= 0) & (start + size <= F.col("_n")))
            .select((F.col("_no") * 2 + (off == 0).cast("int")).alias("_as"), F.xxhash64(lo, k, F.substring("_flat", start + 1, size)).alias("_key")))


def fingerprints(lines: DataFrame, keys: list[str]) -> DataFrame:
    """``keys`` and ``_f0``, ``_f1``, ..., the parities of the grams of each line (``_flat``,
    ``_n``), a gram's place among them by its hash."""
    grams = lines.select(*keys, "_flat", F.explode(F.sequence(F.lit(1), F.greatest(F.col("_n") - (_GRAM - 1), F.lit(1)))).alias("_i"))
    h = F.xxhash64(F.substring("_flat", F.col("_i"), F.lit(_GRAM)))
    hashed = grams.select(*keys, h.bitwiseAND(_WORDS - 1).alias("_w"), F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftright(h, 8).bitwiseAND(63).cast("int")).alias("_b"))
    words = [F.bit_xor(F.when(F.col("_w") == i, F.col("_b")).otherwise(F.lit(0).cast("long"))) for i in range(_WORDS)]
    return hashed.groupBy(*keys).agg(*[w.alias(f"_f{i}") for i, w in enumerate(words)])


def line_decisions(docs: DataFrame, max_edits: int | None = None, min_chars: int = MIN_CHARS,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(_id, _stay, _near)`` per document with a judged line: the places of
    first occurrences that stay, and of those that go as near repeats."""
    checkpoint_dir(docs.sparkSession)
    own = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).where("_text IS NOT NULL")
    judged = F.length("_line") >= min_chars
    placed = own.select("_id", F.posexplode(F.split("_text", _SEP)).alias("_pos", "_line")).where(judged)
    first = (placed.select(F.xxhash64("_line").alias("_h"), F.xxhash64(F.lit(1), "_line").alias("_g"), F.struct("_id", "_pos").alias("_at"))
             .groupBy("_h", "_g").agg(F.min("_at").alias("_at")).select("_at._id", "_at._pos"))
    firsts = first.groupBy("_id").agg(F.collect_set("_pos").alias("_firsts")).checkpoint()  # no longer than the document
    if max_edits != 0:
        near = _near_repeats(own, firsts, max_edits, min_chars).groupBy("_id").agg(F.collect_set("_pos").alias("_near"))
        firsts = firsts.join(near.withColumnRenamed("_id", "_n"), F.col("_id").eqNullSafe(F.col("_n")), "left").drop("_n")
    else:
        firsts = firsts.withColumn("_near", F.lit(None).cast("array<int>"))
    near = F.coalesce("_near", F.array().cast("array<int>"))
    return firsts.select("_id", F.array_except("_firsts", near).alias("_stay"), near.alias("_near"))


def _numbered(firsts: DataFrame) -> DataFrame:
    """``firsts(_id, _firsts)`` with ``_before``: the number of the first of
    them is one more. Numbers ascend with the places."""
    placed = (firsts.repartitionByRange("_id").sortWithinPartitions("_id")
              .select("_id", F.array_sort("_firsts").alias("_firsts"), F.spark_partition_id().alias("_part")).checkpoint())
    ahead = Window.partitionBy("_part").orderBy("_id").rowsBetween(Window.unboundedPreceding, -1)
    within = F.coalesce(F.sum(F.size("_firsts")).over(ahead), F.lit(0))
    return placed.select("_id", "_firsts", (F.shiftleft(F.col("_part").cast("long"), 40) + within).alias("_before")).checkpoint()


def _near_repeats(own: DataFrame, firsts: DataFrame, max_edits: int | None, min_chars: int) -> DataFrame:
    """``(_id, _pos)`` of the first occurrences that an earlier line is near."""
    numbered = _numbered(firsts)
    lines = (own.join(numbered.withColumnRenamed("_id", "_i"), F.col("_id").eqNullSafe(F.col("_i")))
             .select("_firsts", "_before", F.posexplode(F.split("_text", _SEP)).alias("_pos", "_line"))
             .select("_before", F.array_position("_firsts", F.col("_pos")).alias("_at"), "_line").where("_at > 0")
             .select((F.col("_before") + F.col("_at")).alias("_no"), single_bytes(F.col("_line")).alias("_flat"), F.length("_line").alias("_n")))
    own_as, key = F.when(F.col("_as") % 2 == 1, F.col("_as")), Window.partitionBy("_key")
    # a key's earliest line, how many lines it has, and the lines that it brings together
    seen = (segment_keys(in_classes(lines, max_edits, min_chars))
            .select("_key", "_as", F.min(own_as).over(key).alias("_first"), F.count(own_as).over(key).alias("_in"))
            .where((F.col("_first") < F.col("_as") - F.col("_as") % 2) | (F.col("_as") % 2 == 1) & (F.col("_in") > 1))
            .select("_key", F.shiftright("_first", 1).alias("_a"), F.shiftright("_as", 1).alias("_no"), (F.col("_as") % 2 == 1).alias("_mine"), "_in").checkpoint())
    # a line of its own key is one of those that the key has
    met = seen.where("_a < _no").select("_key", "_a", F.col("_no").alias("_b"), (F.col("_in") > 1 + F.col("_mine").cast("int")).alias("_more"))
    places = numbered.select("_id", "_before", F.posexplode("_firsts").alias("_at", "_pos")).select(
        "_id", "_pos", (F.col("_before") + F.col("_at") + 1).alias("_no"))

    def texts_of(numbers: DataFrame) -> DataFrame:
        """``(_x, _line)`` of the lines with the numbers ``_x``."""
        few = numbers.count() <= BROADCAST_LINES
        needed = places.join(F.broadcast(numbers) if few else numbers, F.col("_no") == F.col("_x")).select(
            F.col("_id").alias("_i"), F.col("_pos").alias("_p"), "_x")
        if few:
            needed = F.broadcast(needed)  # else the texts are shuffled to the places
        return (own.select("_id", F.posexplode(F.split("_text", _SEP)).alias("_pos", "_line"))
                .join(needed, F.col("_id").eqNullSafe(F.col("_i")) & (F.col("_pos") == F.col("_p"))).select("_x", "_line").checkpoint())

    def verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
        """The ``_b`` of the pairs that are near."""
        both = (pairs.select("_a", "_b").join(texts.select(F.col("_x").alias("_a"), F.col("_line").alias("_la")), "_a")
                .join(texts.select(F.col("_x").alias("_b"), F.col("_line").alias("_lb")), "_b"))
        allowed = allowed_edits(F.least(F.length("_la"), F.length("_lb")), max_edits, min_chars)
        some = both.withColumn("_e", allowed).where(F.abs(F.length("_la") - F.length("_lb")) <= F.col("_e"))
        return some.where(_near(F.col("_la"), F.col("_lb"), F.col("_e"), limits)).select("_b").distinct().checkpoint()

    texts = texts_of(met.select(F.explode(F.array("_a", "_b")).alias("_x")).distinct().checkpoint())
    limits = [r["_e"] for r in texts.select(allowed_edits(F.length("_line"), max_edits, min_chars).alias("_e")).distinct().collect()]
    voted = met.groupBy("_b", "_a").agg(F.count("*").alias("_v"))
    best = voted.groupBy("_b").agg(F.max_by("_a", F.struct("_v", "_a")).alias("_a")).checkpoint()
    settled = verified(best, texts)
    others = voted.join(settled, "_b", "left_anti").join(best, ["_a", "_b"], "left_anti").select("_a", "_b").checkpoint()
    settled = settled.union(verified(others, texts))
    rest = met.where("_more").join(settled, "_b", "left_anti").select("_key", "_b").distinct().checkpoint()
    if not rest.isEmpty():
        held = seen.where("_mine").select("_key", F.col("_no").alias("_x"))  # all of them met, or were met
        settled = settled.union(_rest(held, rest, texts, limits, max_edits, min_chars))
    near = settled.distinct()
    return places.join(near, F.col("_no") == F.col("_b")).select("_id", "_pos")


def _near(a: Column, b: Column, edits: Column, limits: list[int]) -> Column:
    """Whether two texts are at most ``edits`` apart, one of ``limits`` (one a
    doubling of lengths): they are cut to where they differ, what Spark's own
    thresholded distance does not reject there is verified."""
    def close(p: Column) -> Column:
        near = F.lit(False)
        for limit in sorted(limits):
            near = F.when(edits == limit, edit_distance_within(p["a"], p["b"], limit) <= limit).otherwise(near)
        return F.when(F.call_function("levenshtein", p["a"], p["b"], edits) >= 0, near).otherwise(False)

    return _bind(differing_middles(a, b, edits), close)


def _rest(held: DataFrame, rest: DataFrame, texts: DataFrame, limits: list[int], max_edits: int | None, min_chars: int) -> DataFrame:
    """The lines of ``rest(_key, _b)`` that are near any earlier line of their keys in ``held(_key, _x)``."""
    holders = held.join(rest.select("_key").distinct(), "_key", "left_semi").distinct().checkpoint()
    numbers = holders.select("_x").union(rest.select("_b")).distinct()
    lines = texts.join(numbers, "_x", "left_semi").select("_x", "_line", F.length("_line").alias("_n"))
    lines = lines.withColumn("_e", allowed_edits(F.col("_n"), max_edits, min_chars)).checkpoint()
    flat = lines.select("_x", single_bytes(F.col("_line")).alias("_flat"), "_n")
    known = fingerprints(flat, ["_x"]).join(lines, "_x").checkpoint()
    words = [f"_f{i}" for i in range(_WORDS)]

    def side(keyed: DataFrame, number: str, end: str) -> DataFrame:
        listed = keyed.groupBy(F.col(number).alias("_x")).agg(F.collect_set("_key").alias("_keys"))
        return listed.join(known, "_x").select(
            F.col("_x").alias(number), *[F.col(c).alias(f"{c}{end}") for c in ("_keys", "_n", "_e", *words, "_line")], F.explode("_keys").alias(f"_key{end}"))

    allowed = F.least("_ea", "_eb")  # by columns, as it is looked at for every pair
    turned = reduce(lambda x, y: x + y, [F.bit_count(F.col(f"{w}a").bitwiseXOR(F.col(f"{w}b"))) for w in words])
    near = ((F.col("_keyb") == F.col("_keya")) & (F.col("_a") < F.col("_b")) & (F.abs(F.col("_na") - F.col("_nb")) <= allowed)
            & (turned <= 2 * _GRAM * allowed) & (F.col("_keya") == F.array_min(F.array_intersect("_keysa", "_keysb")))
            & _near(F.col("_linea"), F.col("_lineb"), allowed, limits))
    # a semi join: a line is written at most once a key, and looked at until the first near one; two lines
    # of several keys are compared by the least of these
    return side(rest, "_b", "b").join(side(holders, "_x", "a").withColumnRenamed("_x", "_a"), near, "left_semi").select("_b").distinct().checkpoint()


def _short_repeats(docs: DataFrame, times: int, min_chars: int, id_col: str, text_col: str) -> DataFrame:
    """``(_id, _short)`` per document: the places of its shorter lines that go."""
    placed = (docs.select(F.col(id_col).alias("_id"), F.posexplode(F.split(text_col, _SEP)).alias("_pos", "_line"))
              .where((F.length("_line") < min_chars) & F.col("_line").rlike(r"\S"))
              .select(F.xxhash64("_line").alias("_h"), F.xxhash64(F.lit(1), "_line").alias("_g"), F.struct("_id", "_pos").alias("_at")))
    often = (placed.groupBy("_h", "_g").agg(F.count("*").alias("_n"), F.min("_at").alias("_first"))
             .where(F.col("_n") >= times).drop("_n").checkpoint())
    if often.count() <= BROADCAST_LINES:
        often = F.broadcast(often)
    gone = placed.join(often, ["_h", "_g"]).where(F.col("_at") > F.col("_first"))
    return gone.groupBy("_at._id").agg(F.collect_set("_at._pos").alias("_short"))


def dedup_lines(docs: DataFrame, max_edits: int | None = None, min_chars: int = MIN_CHARS, id_col: str = "doc_id",
                text_col: str = "text", counts: bool = False, short_repeats: int | None = None) -> DataFrame:
    """``docs`` without the repeated lines of their texts; of lines under
    ``min_chars`` those that stand ``short_repeats`` times or more (2: every
    exact repeat; none, if not given) keep their first place only. With
    ``counts`` also ``n_lines``, ``n_removed`` and ``n_near`` (removed as near repeats)."""
    found = line_decisions(docs, max_edits, min_chars, id_col, text_col).select(
        F.col("_id").alias("_who"), "_stay", "_near")
    joined, short = docs.join(found, F.col(id_col).eqNullSafe(F.col("_who")), "left"), F.array().cast("array<int>")
    if short_repeats:
        gone = _short_repeats(docs, max(2, short_repeats), min_chars, id_col, text_col).select(F.col("_id").alias("_whose"), "_short")
        joined, short = joined.join(gone, F.col(id_col).eqNullSafe(F.col("_whose")), "left"), F.coalesce("_short", short)
    # no row in ``found``: no line of the document is a first occurrence
    stay = F.coalesce("_stay", F.array().cast("array<int>"))
    lines = "_".join(["", *docs.columns])  # longer than any column's name
    joined = joined.withColumn(lines, F.split(text_col, _SEP))  # columns, as expressions with lambdas are not shared
    joined = joined.withColumn(f"{lines}_kept", F.filter(lines, lambda x, i: F.when(F.length(x) < min_chars, ~F.array_contains(short, i))
                                                         .otherwise(F.array_contains(stay, i))))
    n, left = F.size(lines), F.size(f"{lines}_kept")
    text = F.array_join(f"{lines}_kept", _SEP)
    more = [F.coalesce(n, F.lit(0)).alias("n_lines"), F.coalesce(n - left, F.lit(0)).alias("n_removed"),
            F.coalesce(F.size("_near"), F.lit(0)).alias("n_near")] if counts else []
    return joined.select(*(text.alias(c) if c == text_col else F.col(c) for c in docs.columns), *more)
