"""Benchmark decontamination by templates.

Texts become sequences of word and number tokens. A template puts typed placeholders for
numbers, units and, in one of two variants, names (capitalised words inside a
sentence); the other variant keeps all words in lower case, so that a change of case
hides nothing. A third variant has no placeholders at all: the raw tokens in lower case, all
of whose windows count, so that exact copies are found whatever they consist of. Windows of template tokens of the benchmark and of the documents are
joined by hash. Along each alignment of a document with an item the raw values of the
placeholders must map consistently: an item's number, name or unit always to the same
value in the document. Of an alignment that does not, its longest consistent stretch of
neighbouring windows counts. So a question asked again with other numbers is found, and a
chance likeness of forms is not.

Before the join, a Bloom filter of fixed size built from the benchmark's windows drops
the windows that cannot match; it is the only thing sent to all tasks.

Rules for unusual rows: a null or empty text matches nothing; a null doc_id is kept;
repeated rows are judged each; repeated items (by id or by text) are matched each, null
items' texts never; items of fewer than SHORTEST tokens are looked for word for word only,
so a row of one word finds every text with that word; an item shorter than a window is one
window. Other columns of both tables are ignored.
"""

from __future__ import annotations

import functools
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.common import keep

WINDOW = 8  # tokens
SHORTEST = 5  # tokens of an item with placeholders, or of words that are no placeholders in a window of WINDOW
RUN = 13  # aligned tokens that are enough by themselves
COVERAGE = 0.5  # share of an item's windows that is enough
FILTER_BITS = 1 << 26
TOKEN = re.compile(r"[^\W\d_]+|[.!?\n]|[0-9]+(?:[.,:/][0-9]+)*")
NUMBER_WORDS = frozenset(
    "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen"
    " eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million billion".split()
)
UNITS = frozenset(
    "mm cm km kg mg ml kb mb gb tb kw kwh mph kmh meter meters metre metres mile miles foot feet inch inches yard yards"
    " gram grams kilogram kilograms pound pounds ounce ounces ton tons liter liters litre litres gallon gallons second"
    " seconds minute minutes hour hours day days week weeks month months year years dollar dollars euro euros cent cents"
    " percent degree degrees watt watts volt volts".split()
)
NUMBER, UNIT, NAME = "\x01", "\x02", "\x03"  # cannot be tokens
_CHARACTER, _STIR = 0xD1342543DE82EF95, 0xBF58476D1CE4E5B9  # odd; powers of the first weigh the places of a token
_MULTIPLIER = 0x9E3779B97F4A7C15  # odd; powers of it weigh the places of a window
RAW = 2
VARIANTS = (0, 1, RAW)  # names as words, names as placeholders, no placeholders


def form_of(token: str) -> str:
    """The token in a template that keeps names as words."""
    low = token.lower()
    return NUMBER if token[0].isdigit() or low in NUMBER_WORDS else UNIT if low in UNITS else low


def is_capitalised(token: str) -> bool:
    return token[0].isupper() and token[1:].islower()


@functools.cache
def worker_scanner() -> Scanner:
    """One per worker process; its tables have a fixed size."""
    return Scanner()


def tokens_of(text: str | None) -> tuple[list[str], list[tuple[str, ...]]]:
    """Raw tokens, and the template tokens of each variant."""
    raw, plain, named, starts = [], [], [], True
    for token in TOKEN.findall(text or ""):
        if token in ".!?\n":
            starts = True
            continue
        low, form = token.lower(), form_of(token)
        raw.append(low)
        plain.append(form)
        name = form == low and not starts and is_capitalised(token)
        named.append(NAME if name else form)
        starts = False
    return raw, [tuple(plain), tuple(named), tuple(raw)]


def _mixed(x: np.ndarray) -> np.ndarray:
    """The numbers' bits stirred, so that neighbours differ in all places."""
    x = (x + np.uint64(1)) * np.uint64(_STIR)
    x = (x ^ x >> np.uint64(31)) * np.uint64(_MULTIPLIER)
    return x ^ x >> np.uint64(32)


def token_hash(form: str) -> int:
    """Hash of a token in lower case: its characters' numbers weighed by powers, as `Scanner` takes it from whole texts."""
    # capital I with a dot is one character to the scanner; the final sigma is the other one
    folded = np.array([ord(c) for c in form.replace("i\u0307", "\u0130").replace("\u03c2", "\u03c3")], dtype=np.uint64)
    power = np.array([pow(_CHARACTER, i, 1 << 64) for i in range(len(folded))], dtype=np.uint64)
    return int(_mixed(np.array([(_mixed(folded) * power).sum(dtype=np.uint64)]))[0])


def window_hashes(each: np.ndarray, width: int, variant: int) -> np.ndarray:
    """A hash per window start, from the hashes of the template tokens."""
    n = len(each) - width + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    # hashes of 1, 2, 4 ... tokens, each from two of the half, put together to the width
    sizes = [1 << i for i in range(width.bit_length())]
    power = [np.uint64(pow(_MULTIPLIER, size, 1 << 64)) for size in sizes]
    blocks = [each]
    for size, by in zip(sizes[:-1], power, strict=False):
        blocks.append(blocks[-1][:-size] * by + blocks[-1][size:])
    total, done = np.uint64(0), 0
    for size, by, block in zip(sizes[::-1], power[::-1], blocks[::-1], strict=True):
        if width & size:
            part = block[done : done + n]
            total, done = total * by + part if done else part, done + size
    return _finished(total, width, variant)


def window_hashes_at(each: np.ndarray, width: int, variant: int, at: np.ndarray) -> np.ndarray:
    """What `window_hashes` gives for a few starts."""
    power = np.array([pow(_MULTIPLIER, width - 1 - i, 1 << 64) for i in range(width)], dtype=np.uint64)
    return _finished((each[at[:, None] + np.arange(width)] * power).sum(axis=1, dtype=np.uint64), width, variant)


def _finished(total: np.ndarray, width: int, variant: int) -> np.ndarray:
    total = total + np.uint64(((width << 2) + variant) * pow(_MULTIPLIER, width, 1 << 64) & (1 << 64) - 1)
    return total ^ total >> np.uint64(29)


@dataclass
class Scanned:
    """A text's tokens without the ends of sentences: hashes of each variant, where they stand, which are placeholders."""

    text: str
    hashes: list[np.ndarray]
    begin: np.ndarray
    end: np.ndarray
    holders: list[np.ndarray]

    def slots(self, variant: int, at: int, width: int) -> list[str]:
        """Raw values of the placeholders of a window."""
        if variant == RAW:
            return []
        places = at + np.flatnonzero(self.holders[variant][at : at + width])
        return [self.text[self.begin[i] : self.end[i]].lower() for i in places]


class Scanner:
    """Tokens and template hashes of whole texts at numpy's speed, as `tokens_of` gives them.

    Characters are looked up in tables of flags and numbers, which grow to the largest character seen;
    a token's hash is the difference of two running sums over weighed characters. Long texts are taken
    in segments of about SEGMENT characters, which end where no token can go on.
    """

    SEGMENT = 1 << 19
    LETTER, DIGIT, END, UPPER, TITLE, LOWER, JOINS, NUMERIC = (1 << i for i in range(8))

    def __init__(self):
        self._flags, self._numbers = np.zeros(0, dtype=np.uint8), np.zeros(0, dtype=np.uint64)
        self._know(1 << 16)
        self._power, self._back = np.ones(1, dtype=np.uint64), np.ones(1, dtype=np.uint64)
        special = {token_hash(w): NUMBER for w in NUMBER_WORDS} | {token_hash(w): UNIT for w in UNITS}
        self._special = np.array(sorted(special), dtype=np.uint64)
        self._forms = np.array([token_hash(special[int(h)]) for h in self._special], dtype=np.uint64)
        self._may_be = np.zeros(1 << 16, dtype=bool)
        self._may_be[self._special >> np.uint64(48)] = True
        self._number, self._name = np.uint64(token_hash(NUMBER)), np.uint64(token_hash(NAME))

    def _know(self, size: int) -> None:
        """Extend the tables to the characters below `size`."""
        more = [chr(i) for i in range(len(self._flags), size)]
        tests = [
            (self.LETTER, lambda c: c.isalnum() and not c.isdecimal()),
            (self.DIGIT, "0123456789".__contains__),
            (self.END, ".!?\n".__contains__),
            (self.UPPER, str.isupper),
            (self.TITLE, lambda c: c.istitle() and not c.isupper()),
            (self.LOWER, str.islower),
            (self.JOINS, ".,:/".__contains__),
            (self.NUMERIC, str.isdigit),
        ]
        flags = sum(np.fromiter(map(test, more), dtype=bool, count=len(more)) * np.uint8(bit) for bit, test in tests)
        low = np.fromiter((ord(d) if len(d := c.lower()) == 1 else ord(c) for c in more), dtype=np.uint64, count=len(more))
        low[low == 0x3C2] = 0x3C3
        self._flags = np.concatenate([self._flags, flags.astype(np.uint8)])
        self._numbers = np.concatenate([self._numbers, _mixed(low)])

    def _weigh(self, size: int) -> None:
        """Powers of the weight and of its inverse, for `size` places."""
        each = np.full(size, _CHARACTER, dtype=np.uint64), np.full(size, pow(_CHARACTER, -1, 1 << 64), dtype=np.uint64)
        for powers in each:
            powers[0] = 1
        self._power, self._back = map(np.multiply.accumulate, each)

    def _cuts(self, text: str) -> Iterator[tuple[int, int]]:
        """Segments; a cut stands before a space."""
        at = 0
        while len(text) - at > self.SEGMENT:
            cut = text.find(" ", at + self.SEGMENT)
            if cut < 0:
                break
            yield at, cut
            at = cut
        yield at, len(text)

    def _segment(self, text: str) -> tuple[np.ndarray, ...]:
        """(begin, end, hash, whether a number by its first character, capitalised, ends of sentences before) per token, and all ends."""
        chars = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        if len(chars) and (most := int(chars.max())) >= len(self._flags):
            self._know(most + 1 if most > 1 << 17 else 1 << 17)
        if len(chars) >= len(self._power):
            self._weigh(2 * len(chars))
        flags = self._flags[chars]
        kind = flags & (self.LETTER | self.DIGIT)
        joins = np.flatnonzero(flags[1:-1] & self.JOINS > 0) + 1
        joins = joins[(flags[joins - 1] & flags[joins + 1] & self.DIGIT) > 0]
        kind[joins] = self.DIGIT
        inner = np.flatnonzero(kind[1:] != kind[:-1]) + 1
        begin, end = np.append(0, inner), np.append(inner, len(chars))
        tokens = kind[begin] > 0 if len(chars) else np.zeros(1, dtype=bool)
        begin, end = begin[tokens], end[tokens]
        sums = np.zeros(len(chars) + 1, dtype=np.uint64)
        np.cumsum(self._numbers[chars] * self._power[: len(chars)], out=sums[1:])
        hashes = _mixed((sums[end] - sums[begin]) * self._back[begin])
        capital = (flags[begin] & self.UPPER) > 0
        some = np.flatnonzero(capital)  # of these the rest must be lower case: no capital in it, one letter that has a case
        large = np.flatnonzero(flags & (self.UPPER | self.TITLE) > 0)
        caseless = np.flatnonzero((flags & (self.LETTER | self.UPPER | self.TITLE | self.LOWER)) == self.LETTER)
        first, last = begin[some] + 1, end[some]
        rest = np.searchsorted(caseless, last) - np.searchsorted(caseless, first)
        capital[some] = (np.searchsorted(large, last) == np.searchsorted(large, first)) & (last - first > rest)
        stops = np.flatnonzero((flags & self.END > 0) & (kind == 0))
        return begin, end, hashes, (flags[begin] & self.NUMERIC) > 0, capital, np.searchsorted(stops, begin), np.array([len(stops)])

    def scan(self, text: str | None) -> Scanned:
        text = text or ""
        cuts = list(self._cuts(text))
        parts = [self._segment(text[a:b] if len(cuts) > 1 else text) for a, b in cuts]
        begin, end = (np.concatenate([p[i] + a for p, (a, _) in zip(parts, cuts, strict=True)]) for i in (0, 1))
        raw, number, capital = (np.concatenate([p[i] for p in parts]) for i in (2, 3, 4))
        stops = np.cumsum([0] + [int(p[6][0]) for p in parts])
        before = np.concatenate([p[5] + n for p, n in zip(parts, stops, strict=False)])
        starts = np.ones(len(raw), dtype=bool)
        starts[1:] = before[1:] != before[:-1]
        plain = np.where(number, self._number, raw)
        some = np.flatnonzero(self._may_be[raw >> np.uint64(48)] & ~number)
        place = np.minimum(np.searchsorted(self._special, raw[some]), len(self._special) - 1)
        some, place = some[same := self._special[place] == raw[some]], place[same]
        plain[some] = self._forms[place]
        holder = number.copy()
        holder[some] = True
        name = capital & ~starts & ~holder
        return Scanned(text, [plain, np.where(name, self._name, plain), raw], begin, end, [holder, holder | name])

    def templates(self, text: str | None) -> list[np.ndarray]:
        """Hashes of the template tokens of each variant."""
        return self.scan(text).hashes


def informative(template: tuple[str, ...], width: int) -> np.ndarray:
    """Whether a window has enough words that are no placeholders: SHORTEST of WINDOW, all but two of shorter ones."""
    words = np.array([t not in (NUMBER, UNIT, NAME) for t in template], dtype=np.int64)
    sums = np.concatenate([[0], np.cumsum(words)])
    return sums[width:] - sums[: len(sums) - width] >= min(SHORTEST, max(width - 2, 2))


def slots(template: tuple[str, ...], raw: list[str], start: int, width: int) -> list[str]:
    return [raw[i] for i in range(start, start + width) if template[i] in (NUMBER, UNIT, NAME)]


def benchmark_windows(benchmark: DataFrame, shortest: int = SHORTEST) -> DataFrame:
    """(hash, item_id, variant, width, at, slots, windows, gate): all raw and all informative windows of items of `shortest` tokens or more.

    The gate of a raw window is the hash of its template with names as words: equal raw windows have equal gates.
    """

    def run(pdfs: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in pdfs:
            rows = []
            for item_id, text in zip(pdf["item_id"], pdf["text"], strict=True):
                raw, templates = tokens_of(text)
                if item_id is None or len(raw) < shortest:
                    continue
                width = min(WINDOW, len(raw))
                for variant in VARIANTS if len(raw) >= SHORTEST else (RAW,):
                    each = np.array([token_hash(t) for t in templates[variant]], dtype=np.uint64)
                    hashes = window_hashes(each, width, variant)
                    plain = np.array([token_hash(t) for t in templates[0]], dtype=np.uint64)
                    gates = window_hashes(plain, width, 0).view(np.int64)
                    good = np.ones(len(hashes), dtype=bool) if variant == RAW else informative(templates[variant], width)
                    for at in np.flatnonzero(good):
                        values = slots(templates[variant], raw, at, width)
                        rows.append((int(hashes[at].view(np.int64)), int(item_id), variant, width, int(at), values, int(good.sum()), int(gates[at])))
            yield pd.DataFrame(rows, columns=["hash", "item_id", "variant", "width", "at", "slots", "windows", "gate"])

    picked = benchmark.select(F.col("item_id").cast("long").cast("string").alias("item_id"), F.col("text").cast("string"))
    found = picked.distinct().mapInPandas(run, "hash long, item_id long, variant int, width int, at int, slots array<string>, windows int, gate long")
    return keep(found, "leak-windows")


def bloom(windows: DataFrame) -> np.ndarray:
    """FILTER_BITS bits as 64-bit words, set for the windows' hashes; at most FILTER_BITS / 64 rows come to the driver."""
    place = F.col("hash").bitwiseAND(FILTER_BITS - 1)
    words = windows.select(F.shiftright(place, 6).alias("word"), F.expr("shiftleft(1L, cast(hash & 63 as int))").alias("bit"))
    bits = np.zeros(FILTER_BITS // 64, dtype=np.uint64)
    for r in words.groupBy("word").agg(F.bit_or("bit").alias("bits")).collect():
        bits[r.word] = np.uint64(r.bits & (1 << 64) - 1)
    return bits


def inside(hashes: np.ndarray, words: np.ndarray) -> np.ndarray:
    """The places of those hashes that the filter lets pass."""
    place = hashes & np.uint64(FILTER_BITS - 1)
    return np.flatnonzero(words[place >> np.uint64(6)] >> (hashes & np.uint64(63)) & np.uint64(1))


HIT = "array<struct<hash: bigint, variant: int, at: int, slots: array<string>>>"


def hits_column(text: Column, windows: DataFrame) -> Column:
    """The windows of a text that may be in the benchmark."""
    gates = windows.where(F.col("variant") == RAW).select(F.col("gate").alias("hash"))
    bits = windows.sparkSession.sparkContext.broadcast(bloom(windows.select("hash").union(gates)))
    forms = [(r.width, r.variant) for r in windows.select("width", "variant").distinct().orderBy("width", "variant").collect()]  # at most WINDOW widths

    @F.pandas_udf(HIT)
    def run(texts: pd.Series) -> pd.Series:
        return pd.Series([hits for group in groups_of(texts) for hits in hits_of(group, forms, bits.value)])

    return run(text.cast("string"))


def groups_of(texts: pd.Series, characters: int = 1 << 17) -> Iterator[list[str]]:
    """Neighbouring texts of together about that many characters; null is empty."""
    group, size = [], 0
    for text in texts:
        group.append(text or "")
        size += len(group[-1])
        if size >= characters:
            yield group
            group, size = [], 0
    if group:
        yield group


def hits_of(group: list[str], forms: list[tuple[int, int]], words: np.ndarray) -> list[list[dict]]:
    """Per text its windows of the forms (width, variant) that the filter lets pass; all texts are scanned at once."""
    scanned = worker_scanner().scan("\n".join(group))
    sizes = np.array([len(t) + 1 for t in group])
    offset = np.cumsum(sizes) - sizes
    owner = np.searchsorted(offset, scanned.begin, side="right") - 1
    first = np.searchsorted(scanned.begin, offset)
    each, found, gated = scanned.hashes, [[] for _ in group], {}

    def passing(width: int, variant: int) -> tuple[np.ndarray, np.ndarray]:
        hashes = window_hashes(each[variant], width, variant)
        place = inside(hashes, words)
        place = place[owner[place] == owner[place + width - 1]]  # windows of one text
        return place, hashes[place]

    for width, variant in forms:
        if variant == RAW:  # hashed only where the plain window is in the filter
            place = gated[width] if width in gated else passing(width, 0)[0]
            if not len(place):
                continue
            hashes = window_hashes_at(each[RAW], width, RAW, place)
            some = inside(hashes, words)
            place, hashes = place[some], hashes[some]
        else:
            place, hashes = passing(width, variant)
            if not variant:
                gated[width] = place
        for at, value in zip(place.tolist(), hashes.view(np.int64).tolist(), strict=True):
            text = owner[at]
            found[text].append({"hash": value, "variant": variant, "at": int(at - first[text]), "slots": scanned.slots(variant, at, width)})
    return found


def longest_stretch(windows: list[tuple[int, list[str], list[str]]]) -> list[int]:
    """The most windows (at, item's slots, document's slots), one after the other, in which each value stands for one value.

    Two ends move over the windows in order; the counts say which values the windows between them map.
    """
    windows = sorted(windows, key=lambda w: w[0])
    seen: dict[str, Counter] = {}
    best, first, clashes = (0, 0), 0, 0
    for last, (at, item, doc) in enumerate(windows):
        if last and at != windows[last - 1][0] + 1:
            seen, first, clashes = {}, last, 0
        for b, d in zip(item, doc, strict=True):
            values = seen.setdefault(b, Counter())
            clashes += len(values) == 1 and d not in values
            values[d] += 1
        while clashes:  # a window that clashes with itself goes as well
            for b, d in zip(*windows[first][1:], strict=True):
                values = seen[b]
                values[d] -= 1
                if not values[d]:
                    del values[d]
                    clashes -= len(values) == 1
            first += 1
        best = max(best, (last + 1 - first, -first))
    return [w[0] for w in windows[-best[1] : -best[1] + best[0]]]


def stretch_column(windows: Column) -> Column:
    """`longest_stretch` of arrays of (at, slots, doc_slots)."""

    @F.pandas_udf("array<int>")
    def run(lists: pd.Series) -> pd.Series:
        return pd.Series([longest_stretch([(w["at"], list(w["slots"]), list(w["doc_slots"])) for w in ws]) for ws in lists], dtype=object)

    return run(windows)


def telling_windows(windows: DataFrame) -> DataFrame:
    """(hash, variant, item_id): windows of which every document that matches an item holds one.

    A match needs `least` of an item's windows of one variant: COVERAGE of them, or those of RUN tokens in a row. So
    all but the least - 1 that most items share are enough to find it, and a line that many items have in common
    pairs a document with none of them, unless the line alone is a match.
    """
    shared = windows.groupBy("hash", "variant").agg(F.count_distinct("item_id").alias("items"))
    of_item = Window.partitionBy("item_id", "variant", "windows", "width")  # one item's windows
    place = F.row_number().over(of_item.orderBy(F.desc("items"), "hash", "at"))
    least = F.greatest(F.lit(1), F.least(F.ceil(F.col("windows") * COVERAGE), RUN - F.col("width") + 1))
    ranked = windows.join(shared, ["hash", "variant"]).withColumn("place", place)
    return ranked.where(F.col("place") >= least).select("hash", "variant", "item_id").distinct()


def matches(marked: DataFrame, windows: DataFrame) -> DataFrame:
    """(rid, item_id, coverage, aligned, kind) per row (rid, hits) and item with a consistent alignment or stretch of one.

    kind is exact, or reparameterised where a value differs from the item's.
    """
    hits = marked.select("rid", F.inline("hits")).select("rid", "hash", "variant", F.col("at").alias("doc_at"), F.col("slots").alias("doc_slots"))
    likely = hits.select("rid", "hash", "variant").distinct().join(telling_windows(windows), ["hash", "variant"]).select("rid", "item_id").distinct()
    pairs = likely.join(windows.drop("gate"), "item_id").join(hits, ["rid", "hash", "variant"]).where(F.size("slots") == F.size("doc_slots"))
    pairs = pairs.withColumn("shift", F.col("doc_at") - F.col("at"))
    group = ["rid", "item_id", "variant", "shift"]
    # per alignment: every value of the item stands for one value of the document
    values = pairs.select(*group, F.explode_outer(F.arrays_zip(F.col("slots").alias("b"), F.col("doc_slots").alias("d"))).alias("v"))
    values = values.groupBy(*group, F.col("v.b").alias("b")).agg(F.min("v.d").alias("low"), F.max("v.d").alias("high"))
    steady = values.groupBy(*group).agg(
        F.bool_and(F.coalesce(F.col("low") == F.col("high"), F.lit(True))).alias("steady"),
        F.bool_or(F.coalesce(F.col("b") != F.col("low"), F.lit(False))).alias("changed"),
    )
    spans = pairs.groupBy(*group, "windows", "width").agg(F.collect_set("at").alias("ats"))  # no more than the item's windows
    # a raw alignment is exact only where the templates show no other value beside it
    place = ["rid", "item_id", "shift"]
    beside = pairs.groupBy(*place).agg(F.bool_or(F.col("slots") != F.col("doc_slots")).alias("beside"))
    whole = spans.join(steady.where("steady"), group).join(beside, place)
    whole = whole.withColumn("changed", F.col("changed") | ((F.col("variant") == RAW) & F.col("beside")))
    columns = [*group, "windows", "width", "ats", "changed"]
    # of an alignment that is not steady as a whole its longest steady stretch
    broken = pairs.join(steady.where("not steady").select(*group), group).groupBy(*group, "windows", "width")
    broken = broken.agg(F.collect_set(F.struct("at", "slots", "doc_slots")).alias("stretch"))  # no more than the item's windows
    broken = broken.withColumn("ats", stretch_column(F.col("stretch"))).withColumn("changed", F.lit(True)).where(F.size("ats") > 0)
    lines = whole.select(*columns).union(broken.select(*columns))
    best = lines.groupBy("rid", "item_id", "variant", "windows", "width").agg(
        F.size(F.array_distinct(F.flatten(F.collect_list("ats")))).alias("covered"),
        F.max(F.size("ats")).alias("longest"),
        F.bool_and("changed").alias("changed"),
    )
    best = best.select(
        "rid", "item_id", (F.col("covered") / F.col("windows")).alias("coverage"), (F.col("longest") + F.col("width") - 1).alias("aligned"), "changed"
    )
    best = best.groupBy("rid", "item_id").agg(F.max("coverage").alias("coverage"), F.max("aligned").alias("aligned"), F.bool_and("changed").alias("changed"))
    found = best.where((F.col("coverage") >= COVERAGE) | (F.col("aligned") >= RUN))
    kind = F.when(F.col("changed"), "reparameterised").otherwise("exact")
    return found.select("rid", "item_id", "coverage", F.col("aligned").cast("int").alias("aligned"), kind.alias("kind"))


def _marked(docs: DataFrame, benchmark: DataFrame, *extra: Column) -> tuple[DataFrame, DataFrame]:
    windows = benchmark_windows(benchmark, shortest=1)
    rid = F.monotonically_increasing_id().alias("rid")
    ids = F.col("doc_id").cast("long").alias("doc_id")
    marked = keep(docs.select(rid, ids, *extra, hits_column(F.col("text"), windows).alias("hits")), "leak-hits")
    return marked, matches(marked.where(F.size("hits") > 0).select("rid", "hits"), windows)


def find_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, contaminated, n_items, item_id, coverage, aligned, kind): one row per document, with its best item."""
    marked, found = _marked(docs, benchmark)
    order = F.struct("coverage", "aligned", (-F.col("item_id")).alias("smaller"), "kind")
    best = found.groupBy("rid").agg(F.count("*").alias("n_items"), F.max(order).alias("best"))
    rows = marked.select("rid", "doc_id").join(best, "rid", "left")
    return rows.select(
        "doc_id",
        F.col("best").isNotNull().alias("contaminated"),
        F.coalesce("n_items", F.lit(0).cast("long")).alias("n_items"),
        (-F.col("best.smaller")).alias("item_id"),
        "best.coverage",
        "best.aligned",
        "best.kind",
    )


def drop_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of docs without a passage of the benchmark, all columns as they came."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    marked, found = _marked(docs, benchmark, row)
    return marked.join(found.select("rid").distinct(), "rid", "left_anti").select("row.*")
