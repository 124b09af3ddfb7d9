r"""Secret scan: three fixed patterns, and guess costs for values in credential contexts.

The base spans are leftmost non-overlapping matches per kind (see the patterns below);
matches that fail their length are dropped but still use up their text. The method adds
`guess` spans: a value that follows a credential word in a looser context (`pwd`, `pass`,
`passphrase`, `credential`, `api key`, `auth`, `pin` or a base word, then `is`, `was`, `to`, `->`, `:=`,
`:` or `=`) and would cost an attacker at least MIN_GUESSES guesses.

The guess cost of a value is the cheapest way to cut it into words of a ranked list (any letter
case, simple digit-for-letter swaps), dates, repeats, keyboard walks and brute-force spans:
costs multiply along the cut, a cut of k pieces is multiplied by k! for their unknown
order, and each piece beyond the first adds PIECE guesses. The program keeps, for each prefix and
number of pieces, the least product. For values over VALUE_MAX characters only cuts of at most three pieces
are tried, over the whole value: four cost PIECE ** 3 at least, more than the threshold.

Words come ranked by their count over all documents (a bounded head of the list is
broadcast) after a short fixed list of common passwords. Null and empty texts have no spans.
Repeated documents are scanned each. Only the named columns are read.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Fixed patterns of the result contract.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A | re.I)
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
KINDS = ("assign", "access", "hex", "guess")

CONTEXT = re.compile(
    r"""(?:password|passwd|passphrase|passcode|pwd|pass|pin|secret|token|credentials?|api[_ -]?key|auth)["']?\x20{0,4}"""
    r"""(?::=|->|=>|[:=]|\x20is\x20|\x20was\x20|\x20to\x20|(?<=\x20)(?:is|was|to)\x20)\x20{0,4}["'`]?([!-~]{6,})""", re.A | re.I)

# Common passwords, most usual first.
COMMON = """password 123456 qwerty letmein welcome admin login master dragon monkey football baseball
iloveyou sunshine princess shadow secret root test guest changeme default user hello trustno1""".split()
KEY_ROWS = ("1234567890", "qwertyuiop", "asdfghjkl", "zxcvbnm")  # a common keyboard's rows
SWAPS = str.maketrans("013457@$", "oieastas")  # digits and signs that stand for letters

MIN_GUESSES = 1e10
PIECE = 1e4
WORDS = 20_000
VALUE_MAX = 64
SHORT = 9  # one character more by brute force, or in a repeated unit, costs MIN_GUESSES with the least alphabet
MIN_WALK, MIN_REPEAT = 3, 3
_DATE = re.compile(r"(?:19|20)\d\d([-/._]?)(?:0?[1-9]|1[0-2])\1(?:0?[1-9]|[12]\d|3[01])|(?:0?[1-9]|[12]\d|3[01])([-/._]?)(?:0?[1-9]|1[0-2])\2(?:19|20)?\d\d|(?:19|20)\d\d")


def _neighbours() -> dict[str, set[str]]:
    near: dict[str, set[str]] = {}
    for y, row in enumerate(KEY_ROWS):
        for x, key in enumerate(row):
            around = [(x + dx, y + dy) for dx, dy in ((-1, 0), (1, 0), (0, -1), (1, -1), (-1, 1), (0, 1))]
            near[key] = {KEY_ROWS[b][a] for a, b in around if 0 <= b < len(KEY_ROWS) and 0 <= a < len(KEY_ROWS[b])}
    return near


NEAR = _neighbours()
_KEYS, _DEGREE = len(NEAR), sum(map(len, NEAR.values())) / len(NEAR)


def _alphabet(piece: str) -> int:
    """How many characters a brute-force guesser tries at each place."""
    return (10 * any(c.isdigit() for c in piece) + 26 * any(c.islower() for c in piece)
            + 26 * any(c.isupper() for c in piece) + 33 * any(not c.isalnum() for c in piece))


def _word_cost(piece: str, ranks: dict[str, int]) -> float:
    low = piece.lower()
    rank, extra = ranks.get(low), 1.0
    if rank is None:
        plain = low.translate(SWAPS)
        rank, extra = (ranks.get(plain), 2.0 ** sum(a != b for a, b in zip(low, plain))) if plain != low else (None, 1.0)
    if rank is None:
        return math.inf
    upper = sum(c.isupper() for c in piece)
    if upper and not (upper == 1 and piece[0].isupper()) and upper != len(piece):
        extra *= sum(math.comb(len(piece), k) for k in range(1, min(upper, len(piece) - upper) + 1))
    elif upper:
        extra *= 2
    return rank * extra


def _date_cost(length: int) -> float:
    return 365.0 * 100 * (1 if length <= 8 else 4)


def pieces(value: str, ranks: dict[str, int]) -> Iterator[tuple[int, int, float]]:
    """(start, end, guesses) of every word, date, repeat and keyboard walk inside `value`."""
    n = len(value)
    for i in range(n):
        for j in range(i + 2, min(n, i + 24) + 1):
            cost = _word_cost(value[i:j], ranks)
            if cost < math.inf:
                yield i, j, cost
    for i in range(n):
        found = _DATE.match(value, i)
        if found:
            yield i, found.end(), _date_cost(found.end() - i)
    yield from _runs(value, n // MIN_REPEAT)


def _runs(value: str, units: int) -> Iterator[tuple[int, int, float]]:
    """(start, end, guesses) of every repeat of up to `units` characters and every keyboard walk inside `value`."""
    n, low = len(value), value.lower()
    for unit in range(1, min(units, n // MIN_REPEAT) + 1):
        i = 0
        while i + unit < n:
            j = i
            while j + unit < n and value[j + unit] == value[j]:
                j += 1
            times = (j - i + unit) // unit
            if times >= MIN_REPEAT:
                yield i, i + times * unit, float(_alphabet(value[i:i + unit]) ** unit * times)
            i = max(j, i + 1)
    i = 0
    while i < n:
        j, turns, way = i, 0, None
        while j + 1 < n and low[j + 1] in NEAR.get(low[j], ()):
            step = ord(low[j + 1]) - ord(low[j])
            turns, way, j = turns + (step != way), step, j + 1
        if j - i + 1 >= MIN_WALK:
            yield i, j + 1, _KEYS * (j - i) * _DEGREE ** max(1, min(turns, 12)) * (2.0 if value[i:j + 1] != low[i:j + 1] else 1.0)
        i = max(j, i + 1)


def guess_cost(value: str, ranks: dict[str, int]) -> float:
    """Least number of guesses over all cuts of `value` into pieces; 1 for an empty value.

    Of a value over VALUE_MAX characters, MIN_GUESSES and more may be given as infinite.
    """
    n = len(value)
    if n > VALUE_MAX:
        return _long_cost(value, ranks)
    if not n:
        return 1.0
    ends: list[list[tuple[int, float]]] = [[] for _ in range(n + 1)]
    for i, j, cost in pieces(value, ranks):
        ends[j].append((i, max(1.0, cost)))
    size = max(10, _alphabet(value))
    for j in range(1, n + 1):
        for i in range(j):
            ends[j].append((i, float(size) ** (j - i)))
    best: list[dict[int, float]] = [{0: 1.0}] + [{} for _ in range(n)]
    for j in range(1, n + 1):
        row = best[j]
        for i, cost in ends[j]:
            for k, before in best[i].items():
                if k < 12 and before * cost < row.get(k + 1, math.inf):
                    row[k + 1] = before * cost
    return min(math.factorial(k) * product + PIECE ** (k - 1) for k, product in best[n].items())


def _long_cost(value: str, ranks: dict[str, int]) -> float:
    """Least number of guesses over the cuts of a long value into at most three pieces, infinite if there are none
    under MIN_GUESSES. The work beyond one pass for the runs does not grow with the length."""
    n, size = len(value), max(10, _alphabet(value))
    runs: dict[int, list[tuple[int, float]]] = {}
    for i, j, cost in _runs(value, SHORT):
        runs.setdefault(i, []).append((j, cost))

    def after(i: int) -> dict[int, float]:
        """The ends of the pieces that start at `i`, with the least guesses."""
        out = {j: float(size) ** (j - i) for j in range(i + 1, min(n, i + SHORT) + 1)}
        found = [(j, _word_cost(value[i:j], ranks)) for j in range(i + 2, min(n, i + 24) + 1)] + runs.get(i, [])
        dated = _DATE.match(value, i)
        if dated:
            found.append((dated.end(), _date_cost(dated.end() - i)))
        for j, cost in found:
            if cost < out.get(j, MIN_GUESSES):
                out[j] = max(1.0, cost)
        return out

    least, heads = math.inf, {0: 1.0}
    for k in (1, 2, 3):
        reached: dict[int, float] = {}
        for i, before in heads.items():
            for j, cost in after(i).items():
                if before * cost < reached.get(j, MIN_GUESSES):
                    reached[j] = before * cost
        if n in reached:
            least = min(least, math.factorial(k) * reached.pop(n) + PIECE ** (k - 1))
        # the last piece reaches the end by a short piece or by a run
        heads = {i: x for i, x in reached.items() if k < 2 or n - i <= 24 or i in runs}
    return least


def spans_of(text: str, ranks: dict[str, int]) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of all spans in order; ends are exclusive, in code points."""
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end() - m.start(2) >= 6]
    found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    for m in CONTEXT.finditer(text):
        value = m.group(1).rstrip(".,;:!?)]}\"'`")
        if len(value) >= 6 and _cached_cost(value, ranks) >= MIN_GUESSES:
            found.append((m.start(), 3, m.start(1) + len(value)))
    return sorted(found)


_COSTS: dict[str, float] = {}


def _cached_cost(value: str, ranks: dict[str, int]) -> float:
    if len(_COSTS) > 50_000:
        _COSTS.clear()
    if value not in _COSTS:
        _COSTS[value] = guess_cost(value, ranks)
    return _COSTS[value]


def word_ranks(docs: DataFrame, text_col: str = "text", words: int = WORDS) -> list[str]:
    """The most frequent words of 3 to 24 letters over all documents, ties in word order."""
    each = docs.select(F.explode(F.regexp_extract_all(F.lower(F.col(text_col)), F.lit("[a-z]{3,24}"), F.lit(0))).alias("w"))
    top = each.groupBy("w").count().orderBy(F.desc("count"), "w").limit(words)
    return [r["w"] for r in top.collect()]


def _scanner(words):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks: dict[str, int] = {}
        for word in [*COMMON, *words.value]:
            ranks.setdefault(word, len(ranks) + 1)
        for batch in batches:
            rows = [spans_of(t or "", ranks) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(
                [[{"kind": KINDS[k], "start": a, "end": b} for a, k, b in r] for r in rows], _SPANS)], names=["doc_id", "spans"])

    return run


_SPANS = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS) -> DataFrame:
    """Per document: doc_id and its spans array<struct<kind, start, end>>."""
    head = word_ranks(docs, text_col, words)
    plain = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).alias("text"))
    return plain.mapInArrow(_scanner(docs.sparkSession.sparkContext.broadcast(head)),
                            "doc_id bigint, spans array<struct<kind:string,start:bigint,end:bigint>>")


def digest(scanned: DataFrame) -> DataFrame:
    """The counts and digest columns of the scan's result contract."""
    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def of(kind):
        return F.filter("spans", lambda s: s["kind"] == kind)

    base = F.filter("spans", lambda s: s["kind"] != "guess")
    return scanned.select("doc_id", *(F.size(of(k)).cast("bigint").alias(f"n_{k}") for k in KINDS),
                          F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))
