"""Personal data: base rules, spread by a skip-chain conditional random field.

Base spans come from four rules (email, ip, card, phone). A document that has
one also gets a graph: its nodes are the tokens that hold a digit or an ``@``
and those that are the local part of one of its addresses (any other token is
fixed to "outside", which cuts the chain); neighbours in the text are joined by
chain edges, and all mentions of one key, however far apart, share a hub node.
The keys are the token itself, its digits, the digits of a run of neighbours
("+1 (523) 555-1055"), the last 10 and the last 7 of either, and the local part
of an address: repeated mentions share the first, similar ones the others. A
hub stands for the skip edges among its mentions, so their number is linear in
the mentions. Nodes in base spans are clamped to their
kind; loopy sum-product messages (damped, in logs) then give every other node
a marginal, and a node that shares a hub with a base span, and whose marginal
for a kind reaches ``LEAST``, is added. A document without a base span has no
label to spread.

The potentials are trained piecewise on all documents: a maximum-entropy model
of the token shape, and pointwise mutual information of labels along chain
and skip edges. A token outside of base spans that shares a hub with one has no
known label: it is left out of the counts, so that the field is not taught that
mentions of known data are none. What reaches the driver is their count tables (feature
signatures x labels), whose size the features bound. Two passes: one over the
texts, one over the token tables it leaves in the checkpoint folder.

Defined results: a null text is empty; an empty text has no spans and the
digest of the empty string; repeated rows give a row each; an empty table
gives no rows; other columns are ignored. All rules are linear in the text.
"""

from __future__ import annotations

import bisect
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from siltlake.session import checkpoint_dir

KINDS = ("email", "ip", "card", "phone")
OUTSIDE = len(KINDS)  # the label of a token in no span
LABELS = OUTSIDE + 1
LEAST = 0.9
ROUNDS, DAMPING = 40, 0.5
#: pairs of equal labels that are taken as seen along skip edges, whose mentions are of one thing
SAME = 20.0
#: categories of each shape feature, in the order of ``shape``
SIZES = (4, 3, 2, 2, 3, 7, 2, 2, 2)

_DIGIT = re.compile(r"[0-9]")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# a match can begin only where a run of digits begins: the rest of the run is never a new start
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_TOKEN = re.compile(r"[0-9@]\S*")
_NOT_DIGITS = re.compile(r"[^0-9]+")
_NUMBER = re.compile(r"[0-9().+-]*[0-9][0-9().+-]*")
_WORD = re.compile(r"\S+")
#: numbers with as many last digits in common are similar: a phone number without its country, or without its area
SUFFIXES = (7, 10)
_QUAD = re.compile(r"[0-9]+(?:\.[0-9]+){3}")
_TRIM = "\"'()[]{}<>*#&$%,;:!?.|"


def luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        v = int(d) * (1 + k % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def _octets(text: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in text.split("."))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(kind, start, end)`` by kind, then start; code points, end exclusive."""
    found, at = [], 0
    while (i := text.find("@", at)) >= 0:
        begin = i
        while begin > at and text[begin - 1] in _LOCAL:
            begin -= 1
        m = _DOMAIN.match(text, i) if begin < i else None
        if m:
            found.append((0, begin, m.end()))
        at = m.end() if m else i + 1
    if not _DIGIT.search(text):
        return found
    found += [(1, m.start(), m.end()) for m in _IP.finditer(text) if _octets(m[0])]
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 13:
            digits = _NOT_DIGITS.sub("", m[0])
            if 13 <= len(digits) <= 19 and luhn(digits):
                found.append((2, m.start(), m.end()))
    if "+" in text:
        found += [(3, m.start(), m.end()) for m in _PHONE.finditer(text) if 9 <= len(_NOT_DIGITS.sub("", m[0])) <= 15]
    return found


def tokens_of(text: str) -> list[tuple[int, int]]:
    """Runs of non-space that hold a digit or ``@``, without punctuation at either end."""
    out, last = [], 0
    for m in _TOKEN.finditer(text):
        a, b = m.span()
        while a > last and not text[a - 1].isspace():
            a -= 1
        last = b
        while a < b and text[a] in _TRIM:
            a += 1
        while b > a and text[b - 1] in _TRIM:
            b -= 1
        if a < b:
            out.append((a, b))
    return out


def address_mentions(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """Words outside of base spans that are the local part of one of the
    text's addresses: one with a dot, digit or the like, not a plain word."""
    locals_ = {text[a:b].split("@")[0].lower() for k, a, b in base if k == 0}
    locals_ = {x for x in locals_ if len(x) >= 4 and not x.isalpha()}
    if not locals_:
        return []
    out = []
    for m in _WORD.finditer(text):
        a, b = m.span()
        while a < b and text[a] in _TRIM:
            a += 1
        while b > a and text[b - 1] in _TRIM:
            b -= 1
        if text[a:b].lower() in locals_:
            out.append((a, b))
    return out


def shape(text: str, a: int, b: int, before: bool, after: bool, named: bool = False) -> int:
    """The feature signature of a token, as one number; ``named``: it is the
    local part of an address."""
    word = text[a:b]
    digits = _NOT_DIGITS.sub("", word)
    n = len(digits)
    at = word.find("@")
    quad = _QUAD.fullmatch(word) is not None
    cats = (
        3 if named else 0 if at < 0 else 2 if at > 0 and _DOMAIN.match(word, at) else 1,
        0 if not quad else 2 if _octets(word) else 1,
        int(a > 0 and text[a - 1] == "+" or word[0] == "+"),
        int(a > 0 and text[a - 1] == "("),
        0 if word.isdigit() else 1 if re.fullmatch(r"[0-9().+-]+", word) else 2,
        0 if n <= 2 else 1 if n == 3 else 2 if n == 4 else 3 if n <= 8 else 4 if n <= 12 else 5 if n <= 19 else 6,
        int(13 <= n <= 19 and luhn(digits)),
        int(before), int(after))
    code = 0
    for c, size in zip(cats, SIZES):
        code = code * size + c
    return code


def _one_hot(codes: np.ndarray) -> np.ndarray:
    columns, rest = [], codes.astype(np.int64)
    for size in reversed(SIZES):
        columns.append(np.eye(size)[rest % size])
        rest = rest // size
    return np.hstack([*columns, np.ones((len(codes), 1))])


def keys_of(word: str) -> list[str]:
    """What makes mentions one: the word, its digits, an address's local part."""
    word = word.lower()
    digits = _NOT_DIGITS.sub("", word)
    keys = {word} if len(digits) >= 3 or "@" in word else set()
    if len(digits) >= 6:
        keys.add(digits)
    if _NUMBER.fullmatch(word):
        keys |= {f"{n}:{digits[-n:]}" for n in SUFFIXES if len(digits) >= n}
    if 0 < word.find("@") and len(local := word.split("@")[0]) >= 4:
        keys.add(local)
    if "@" not in word and any(c.isalpha() for c in word) and len(word) >= 4:
        keys.add(word)
    return sorted(keys)


_TOKENS = ("doc_id long, base array<int>, starts array<int>, ends array<int>, shapes array<int>, labels array<int>, known array<int>, "
           "near array<int>, hub_node array<int>, hub array<int>, chain_pairs array<int>, skip_pairs array<int>")


def _token_row(text: str) -> tuple:
    base = base_spans(text)
    named = set(address_mentions(text, base))
    spans = sorted({*tokens_of(text), *named})
    labels, order = [OUTSIDE] * len(spans), sorted((s, e, k) for k, s, e in base)
    starts_only = [s for s, _, _ in order]
    # spans of different kinds may overlap: step back over all that can reach
    longest = max((e - s for s, e, _ in order), default=0)
    for j, (a, b) in enumerate(spans):
        i = bisect.bisect_left(starts_only, a - longest)
        while i < len(order) and order[i][0] < b:
            if order[i][1] > a:
                labels[j] = order[i][2]
                break
            i += 1
    # chain edges: only white space and punctuation between two tokens
    near = [int(j > 0 and not text[spans[j - 1][1]:a].strip(_TRIM + " \t\r\n+-") and a - spans[j - 1][1] <= 4)
            for j, (a, _) in enumerate(spans)]
    shapes = [shape(text, a, b, bool(near[j]), j + 1 < len(spans) and bool(near[j + 1]), (a, b) in named)
              for j, (a, b) in enumerate(spans)]
    hubs: dict[str, int] = {}
    nodes: list[list[int]] = []
    run_of: list[int] = []  # where the run of each token begins
    part_of_run = [_NUMBER.fullmatch(w) is not None and not _QUAD.fullmatch(w) for w in (text[a:b] for a, b in spans)]
    at = 0
    while at < len(spans):  # a run of neighbouring numbers
        end = at + 1
        while end < len(spans) and near[end] and labels[end] == labels[at] and part_of_run[end] and part_of_run[at]:
            end += 1
        words = [text[a:b] for a, b in spans[at:end]]
        run_of += [at] * len(words)
        joined = keys_of("".join(words)) if end > at + 1 else []
        for j, word in zip(range(at, end), words):
            for key in {*keys_of(word), *(k for k in joined if len(_NOT_DIGITS.sub("", k)) >= SUFFIXES[0])}:
                h = hubs.setdefault(key, len(hubs))
                if h == len(nodes):
                    nodes.append([])
                nodes[h].append(j)
        at = end
    nodes = [sorted(own) for own in nodes]
    fed = {h for h, own in enumerate(nodes) if any(labels[j] != OUTSIDE for j in own)}
    unknown = {j for h in fed for j in nodes[h] if labels[j] == OUTSIDE}
    hub_node, hub = [j for own in nodes for j in own], [h for h, own in enumerate(nodes) for _ in own]
    skip_pairs = [labels[i] * LABELS + labels[j] for own in nodes for i, j in zip(own, own[1:])
                  if run_of[i] != run_of[j] and not {i, j} & unknown]  # two mentions, not parts of one
    chain_pairs = [labels[j - 1] * LABELS + labels[j] for j in range(1, len(spans)) if near[j] and not {j - 1, j} & unknown]
    return ([x for s in base for x in s], [a for a, _ in spans], [b for _, b in spans], shapes, labels, [int(j not in unknown) for j in range(len(spans))],
            near, hub_node, hub, chain_pairs, skip_pairs)


def token_table(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Base spans and the token graph of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [f.split()[0] for f in _TOKENS.split(", ")]
        for batch in batches:
            rows = [_token_row(t or "") for t in batch.column(1).to_pylist()]
            columns = list(zip(*rows)) or [()] * (len(names) - 1)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, pa.list_(pa.int32())) for c in columns)], names=names)

    narrow = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return narrow.mapInArrow(run, _TOKENS)


class Potentials:
    """Log potentials, trained piecewise on label counts."""

    def __init__(self, shapes: dict[tuple[int, int], int], chain: dict[int, int], skip: dict[int, int]):
        self.chain, self.skip = self._mutual(chain, 0.0), self._mutual(skip, SAME)
        codes = sorted({c for c, _ in shapes})
        counts = np.array([[shapes.get((c, l), 0) for l in range(LABELS)] for c in codes], dtype=float).reshape(-1, LABELS)
        x = _one_hot(np.array(codes, dtype=np.int64)) if codes else np.zeros((0, sum(SIZES) + 1))
        w, total = np.zeros((x.shape[1], LABELS)), max(counts.sum(), 1.0)
        for _ in range(400):  # regularised softmax regression on the count table
            z = x @ w
            p = np.exp(z - z.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            w += 1.0 * (x.T @ (counts - counts.sum(axis=1, keepdims=True) * p) / total - 1e-4 * w)
        self.weights = w

    @staticmethod
    def _mutual(pairs: dict[int, int], same: float) -> np.ndarray:
        n = np.ones((LABELS, LABELS)) * 0.5 + same * np.eye(LABELS)
        for code, count in pairs.items():
            n[code // LABELS, code % LABELS] += count
        n = (n + n.T) / 2 if len(pairs) else n
        p = n / n.sum()
        return np.log(p / np.outer(p.sum(axis=1), p.sum(axis=0)))

    def unary(self, shapes: np.ndarray) -> np.ndarray:
        z = _one_hot(shapes) @ self.weights
        return z - np.logaddexp.reduce(z, axis=1, keepdims=True)


def marginals(unary: np.ndarray, clamped: np.ndarray, near: np.ndarray, hub_node: np.ndarray, hub: np.ndarray,
              p: Potentials) -> np.ndarray:
    """Label marginals by damped loopy message passing over chain and hubs.
    ``clamped``: the label of a base token, OUTSIDE for the others."""
    u = unary.copy()
    known = np.flatnonzero(clamped != OUTSIDE)
    u[known] = -50.0
    u[known, clamped[known]] = 0.0
    right = np.flatnonzero(near)
    left = right - 1
    size = np.bincount(hub, minlength=hub.max() + 1 if len(hub) else 0)
    keep = size[hub] > 1 if len(hub) else np.zeros(0, bool)
    node, h = hub_node[keep], hub[keep]
    to_right, to_left = np.zeros((len(right), LABELS)), np.zeros((len(right), LABELS))
    to_hub, from_hub = np.zeros((len(h), LABELS)), np.zeros((len(h), LABELS))

    def through(message: np.ndarray, factor: np.ndarray) -> np.ndarray:
        out = np.logaddexp.reduce(message[:, :, None] + factor[None], axis=1)
        return out - np.logaddexp.reduce(out, axis=1, keepdims=True)

    def belief() -> np.ndarray:
        b = u.copy()
        np.add.at(b, right, to_right)
        np.add.at(b, left, to_left)
        np.add.at(b, node, from_hub)
        return b

    for _ in range(ROUNDS):
        b = belief()
        total = np.zeros((len(size), LABELS))
        np.add.at(total, h, to_hub)
        new = (through(b[left] - to_left, p.chain), through(b[right] - to_right, p.chain.T),
               through(b[node] - from_hub, p.skip), through(total[h] - to_hub, p.skip.T))
        old = (to_right, to_left, to_hub, from_hub)
        change = max((float(np.abs(x - y).max()) for x, y in zip(new, old) if len(x)), default=0.0)
        to_right, to_left, to_hub, from_hub = (DAMPING * y + (1 - DAMPING) * x for x, y in zip(new, old))
        if change < 1e-4:
            break
    b = belief()
    return np.exp(b - np.logaddexp.reduce(b, axis=1, keepdims=True))


def added_spans(starts, ends, shapes, labels, near, hub_node, hub, p: Potentials, least: float = LEAST) -> list[tuple[int, int, int]]:
    """The spans that the field adds to a document's base spans."""
    labels, hub_node, hub, near = (np.asarray(x, dtype=np.int64) for x in (labels, hub_node, hub, near))
    known = labels != OUTSIDE
    if not known.any() or known.all():
        return []
    fed = np.unique(hub[known[hub_node]])  # hubs that a base span speaks for
    supported = np.zeros(len(labels), dtype=bool)
    supported[hub_node[np.isin(hub, fed)]] = True
    if not (supported & ~known).any():
        return []
    m = marginals(p.unary(np.asarray(shapes)), labels, near, hub_node, hub, p)
    kind = m[:, :OUTSIDE].argmax(axis=1)
    take = supported & ~known & (m[np.arange(len(kind)), kind] >= least)
    out: list[tuple[int, int, int]] = []
    for j in np.flatnonzero(take):
        k = int(kind[j])
        if out and KINDS[k] in ("card", "phone") and near[j] and take[j - 1] and out[-1][0] == k:
            out[-1] = (k, out[-1][1], ends[j])
        else:
            out.append((k, starts[j], ends[j]))
    return out


def find_pii(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: float = LEAST) -> DataFrame:
    """doc_id, base and added spans as ``array<struct<kind, start, end>>``."""
    spark = docs.sparkSession
    checkpoint_dir(spark)
    tokens = token_table(docs, id_col, text_col).checkpoint()

    def counts(column: str) -> dict:
        rows = tokens.select(F.explode(column).alias("x")).groupBy("x").count()
        return {r["x"]: r["count"] for r in rows.collect()}  # at most LABELS^2 rows

    # at most the number of signatures x LABELS rows
    shapes = tokens.select(F.explode(F.arrays_zip("shapes", "labels", "known")).alias("x")).where("x.known = 1").groupBy("x.shapes", "x.labels").count()
    p = Potentials({(r["shapes"], r["labels"]): r["count"] for r in shapes.collect()}, counts("chain_pairs"), counts("skip_pairs"))
    span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def named(spans):
            return [{"kind": KINDS[k], "start": a, "end": b} for k, a, b in spans]

        for batch in batches:
            base, added = [], []
            for r in batch.to_pylist():
                b = r["base"]
                base.append(named(zip(b[::3], b[1::3], b[2::3])))
                added.append(named(sorted(added_spans(r["starts"], r["ends"], r["shapes"], r["labels"], r["near"],
                                                      r["hub_node"], r["hub"], p, least))) if b else [])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(base, span), pa.array(added, span)],
                                             names=["doc_id", "base", "added"])

    columns = ["doc_id", "base", "starts", "ends", "shapes", "labels", "near", "hub_node", "hub"]
    struct = "array<struct<kind: string, start: int, end: int>>"
    return tokens.select(*columns).mapInArrow(run, f"doc_id long, base {struct}, added {struct}")


def pii_digest(spans: DataFrame) -> DataFrame:
    """The counts, the digest of the base spans and the text of all spans."""
    def text(column):
        return F.array_join(F.transform(column, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    order = F.array(*map(F.lit, KINDS))
    every = F.array_sort(F.transform(F.concat("base", "added"), lambda s: F.struct(
        F.array_position(order, s["kind"]).alias("rank"), s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"))))
    kinds = F.transform("base", lambda s: s["kind"])
    counts = [(F.size("base") - F.size(F.array_remove(kinds, k))).cast("long").alias(f"n_{k}") for k in KINDS]
    return spans.select("doc_id", *counts, F.sha2(text(F.col("base")), 256).alias("base_sha256"),
                        text(every).alias("spans"), F.size("added").cast("long").alias("n_added"))
