"""Benchmark decontamination by template canonicalisation.

Words become tokens: edge punctuation goes, letters are lower-cased (where that keeps their length in UTF-8).  A token that begins with a
digit, or is a number word, is the slot <number>; a unit after a number is <unit>; a run of capitalised words of any alphabet inside a
sentence is one <name>.  Number words and units are those of English, German, French and Spanish.
Windows of ``width`` tokens are hashed and joined with the windows of the benchmark under three readings: the words
themselves, so that verbatim windows meet whatever they hold; templates, with slots in place of their values, so
that a question with other numbers or names still meets its original; and templates in which the capitalised
words that begin a text, line or sentence are names too.  A template window needs a share of ``min_literals`` words that are no slots.
Meetings of templates are then checked: over all positions that the windows of one alignment cover, equal slot values of the item must
face equal values of the document, and different ones different ones, but different numbers that have all changed may become
equal.  Windows that hold a conflicting slot are dropped, verbatim ones too.  An item is found in a document if the
other windows cover ``coverage`` of its words; it is verbatim if every slot value is the same and no slot conflicts.

The benchmark is the stated query set.  It is taken in blocks of about ``BLOCK_BYTES`` of item text, spread by hash.  With one
block, its index is broadcast and documents pass it as they are read, without a shuffle.  With several, documents are numbered and
written once; each block is a job of its own that writes the rows it found something in, and its broadcast is given
up before the next one is made, so one block is held at a time whatever the size of the benchmark.  The hits are then joined to the rows.

Edge cases: an item with fewer tokens than ``width`` is one window of all its tokens; below ``min_tokens`` tokens, or with
numbers only, an item is found by its words alone, never by a template; null and empty texts hold nothing; repeated
rows are judged each; empty tables on either side give no hits; other columns pass through, ``hits`` is replaced.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowlens.llm.arrowtext import LOWER, Texts, Words, mix, parts_of, roller, texts_of, words_of
from flowlens.runtime import materialise, scratch_path

BLOCK_BYTES = 8 << 20
LITERAL, NUMBER, NAME, UNIT = range(4)
SLOT = mix(np.arange(1, 5, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))  # what stands for a slot of each kind

UNITS = """mm cm m km in ft yd mi inch inches foot feet yard yards mile miles meter meters metre metres kilometer kilometers
g kg mg lb lbs oz gram grams kilogram kilograms pound pounds ounce ounces ton tons l ml liter liters litre litres gallon gallons
s ms sec second seconds min minute minutes h hr hour hours day days week weeks month months year years
dollar dollars cent cents euro euros percent degree degrees hz khz mhz ghz w kw v a kb mb gb tb
zoll fuß meile meilen kilometern gramm kilogramm pfund tonne tonnen sekunde sekunden minuten stunde stunden tag tage tagen woche wochen
monat monate monaten jahr jahre jahren prozent grad
pouce pouces pied pieds mètre mètres kilomètre kilomètres gramme grammes kilogramme kilogrammes livre livres tonnes seconde secondes
heure heures jour jours semaine semaines mois an ans année années degré degrés
pulgada pulgadas pie pies milla millas metro metros kilómetro kilómetros gramo gramos kilogramo kilogramos libra libras litro litros
segundo segundos minuto minutos hora horas día días semana semanas mes meses año años grado grados""".split()
NUMBER_WORDS = """zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen
eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million billion
zwei drei vier fünf sechs sieben acht neun zehn zwölf dreizehn vierzehn fünfzehn sechzehn siebzehn achtzehn neunzehn zwanzig
dreißig vierzig fünfzig sechzig siebzig achtzig neunzig hundert tausend millionen
deux trois quatre cinq sept huit neuf dix onze douze treize quatorze quinze seize vingt trente quarante cinquante soixante mille millions
dos tres cuatro cinco seis siete ocho nueve diez doce trece catorce quince dieciséis diecisiete dieciocho diecinueve veinte treinta
cuarenta cincuenta sesenta setenta ochenta noventa cien ciento mil millón millones""".split()

PUNCTUATION = np.zeros(256, bool)
PUNCTUATION[[b for b in range(33, 127) if not chr(b).isalnum()]] = True
DIGIT = np.zeros(256, bool)
DIGIT[48:58] = True
UPPER = np.array([chr(c).isupper() or chr(c).istitle() for c in range(1 << 16)])  # by code point
STOP = np.zeros(256, bool)
STOP[[ord(c) for c in ".!?:;"]] = True
CLOSING = [c.encode() for c in "”’»"]
SMALL = np.array([ord(low) if len(low := chr(c).lower()) == 1 and 0x80 <= ord(low) < 0x800 else c for c in range(0x800)])  # two bytes each


@dataclass(frozen=True)
class Rule:
    width: int = 10
    min_tokens: int = 5
    min_literals: float = 0.6  # share of a window's tokens that are no slots
    coverage: float = 0.5


@dataclass
class Reading:
    template: np.ndarray  # hash of the word, or of the slot kind
    value: np.ndarray  # hash of what stood there
    kind: np.ndarray
    word: np.ndarray  # number of the first word of each token, one more entry than tokens
    first: np.ndarray  # per text, one more entry than texts
    least: float  # share of a window's tokens that must be no slots; 0 for one token

    def items(self, places: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.first, places, "right") - 1


@dataclass
class Tokens:
    words: np.ndarray  # per text, number of its first word, one more entry than texts
    readings: list[Reading]  # the words themselves, then templates


def _hashes(words: list[str]) -> np.ndarray:
    texts = texts_of(pa.array([" ".join(words)]))
    found = words_of(texts)
    return np.sort(roller(21).spans(roller(21).letters[texts.data], found.start, found.end))


_KNOWN: dict[str, np.ndarray] = {}


def _known(name: str, words: list[str]) -> np.ndarray:
    if name not in _KNOWN:
        _KNOWN[name] = _hashes(words)
    return _KNOWN[name]


def _among(values: np.ndarray, listed: np.ndarray) -> np.ndarray:
    return listed[np.minimum(np.searchsorted(listed, values), len(listed) - 1)] == values


def _lowered(data: np.ndarray) -> np.ndarray:
    """UTF-8 bytes with capitals of one and two bytes as small letters; every letter keeps its place."""
    small = LOWER[data]
    lead = np.flatnonzero((data[:-1] >= 0xC2) & (data[:-1] < 0xE0))
    point = SMALL[(data[lead].astype(np.int64) & 31) << 6 | data[lead + 1] & 63]
    small[lead], small[lead + 1] = 0xC0 | point >> 6, 0x80 | point & 63
    return small


def _capital(data: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Whether a capital letter of up to three bytes stands at each place."""
    a, b, c = (data[np.minimum(start + k, len(data) - 1)].astype(np.int64) for k in range(3))
    point = np.where(a < 0x80, a, np.where(a < 0xE0, (a & 31) << 6 | b & 63, (a & 15) << 12 | (b & 63) << 6 | c & 63))
    return UPPER[point] & (a < 0xF0)


def _template(value: np.ndarray, kind: np.ndarray, owner: np.ndarray, n: int, rule: Rule) -> Reading:
    """Tokens with slots; a run of name words is one token."""
    kind = kind.copy()
    after = np.zeros(len(kind), bool)
    after[1:] = (kind[:-1] == NUMBER) & (owner[1:] == owner[:-1])
    kind[after & (kind == LITERAL) & _among(value, _known("units", UNITS))] = UNIT
    joins = np.zeros(len(kind), bool)  # a further word of a name
    joins[1:] = (kind[1:] == NAME) & (kind[:-1] == NAME) & (owner[1:] == owner[:-1])
    keep = np.flatnonzero(~joins)
    word = np.append(keep, len(value))
    value = roller(22).spans(value, keep, word[1:])
    kind, owner = kind[keep], owner[keep]
    return Reading(np.where(kind == LITERAL, value, SLOT[kind]), value, kind, word, np.searchsorted(owner, np.arange(n + 1)), rule.min_literals)


def canonical(texts: Texts, rule: Rule = Rule()) -> Tokens:
    words, data = words_of(texts), texts.data
    owner = np.repeat(np.arange(len(texts)), words.counts())
    if not len(owner):
        return Tokens(np.zeros(len(texts) + 1, np.int64), [])
    solid = np.flatnonzero(~PUNCTUATION[data])
    if not len(solid):
        solid = np.array([len(data)])
    start = solid[np.minimum(np.searchsorted(solid, words.start), len(solid) - 1)]
    end = solid[np.maximum(np.searchsorted(solid, words.end) - 1, 0)] + 1
    real = (start >= words.start) & (start < words.end)
    opens = _opens(data, words, owner, np.where(real, end, words.start))
    start, end, owner, opens = start[real], end[real], owner[real], opens[real]
    value = roller(21).spans(roller(21).letters[_lowered(data)], start, end)
    head = data[start] if len(start) else np.empty(0, np.uint8)
    number = DIGIT[head] | _among(value, _known("numbers", NUMBER_WORDS))
    first = np.searchsorted(owner, np.arange(len(texts) + 1))
    plain = Reading(value, value, np.where(number, NUMBER, LITERAL), np.arange(len(value) + 1), first, 0)
    capital = _capital(data, start)
    inside = np.where(number, NUMBER, np.where(capital & ~opens, NAME, LITERAL))
    anywhere = np.where(number, NUMBER, np.where(capital, NAME, LITERAL))
    return Tokens(first, [plain, *[_template(value, kind, owner, len(texts), rule) for kind in (inside, anywhere)]])


def _opens(data: np.ndarray, words: Words, owner: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Whether each word is the first of a text, line or sentence; ``end`` is where the closing punctuation of each word begins."""
    count = lambda marks: np.concatenate([[0], np.cumsum(marks)])
    stops, lines = count(STOP[data]), count(data == 10)
    last = words.end
    for quote in CLOSING:  # quotes of several bytes are no punctuation: the stop stands before them
        at = np.maximum(last - len(quote), words.start)
        same = last - at == len(quote)
        for k, byte in enumerate(quote):
            same &= data[np.minimum(at + k, len(data) - 1)] == byte
        last, end = np.where(same, at, last), np.where(same, np.maximum(np.minimum(end, at - 1), words.start), end)
    opens = np.ones(len(owner), bool)
    opens[1:] = ((stops[words.end] > stops[np.minimum(end, words.end)])[:-1] | (lines[words.start[1:]] > lines[words.end[:-1]])
                 | (owner[1:] != owner[:-1]))
    return opens


def _windows(tokens: Reading, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Positions and hashes of the windows that lie inside a text and hold enough literal words."""
    n = len(tokens.template)
    if n < width:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    literals = np.concatenate([[0], np.cumsum(tokens.kind == LITERAL)])
    ends = np.repeat(tokens.first[1:], np.diff(tokens.first))
    at = np.arange(n - width + 1)
    good = at[(at + width <= ends[: len(at)]) & (literals[width:] - literals[: len(at)] >= tokens.least * width)]
    return good, roller(23).windows(tokens.template, width)[good]


@dataclass
class Index:
    """The windows of a block of items: per reading and width, sorted hashes with item and place."""

    tokens: Tokens
    by_width: list[dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]]


def build_index(texts: list[str | None], rule: Rule) -> Index:
    tokens = canonical(texts_of(pa.array(texts, pa.large_string())), rule)
    found_by = []
    for reading in tokens.readings:
        sizes, by_width = np.diff(reading.first), {}
        for width in range(rule.min_tokens if reading.least else 1, rule.width + 1):
            at, found = _windows(reading, width)
            item = reading.items(at)
            own = sizes[item] == width if width < rule.width else np.ones(len(at), bool)
            if own.any():
                order = np.argsort(found[own], kind="stable")
                by_width[width] = (found[own][order], item[own][order], (at - reading.first[item])[own][order])
        found_by.append(by_width)
    return Index(tokens, found_by)


def _meetings(reading: Reading, by_width: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]) -> Iterator[tuple[np.ndarray, ...]]:
    for width, (keys, items, places) in by_width.items():
        at, found = _windows(reading, width)
        low = np.searchsorted(keys, found)
        hit = np.flatnonzero(keys[np.minimum(low, len(keys) - 1)] == found)
        low = low[hit]
        many = np.searchsorted(keys, found[hit], "right") - low
        entry = np.repeat(low - np.cumsum(many) + many, many) + np.arange(many.sum())
        yield np.repeat(at[hit], many), items[entry], places[entry], np.full(len(entry), width)


def _conflicts(mine: np.ndarray, theirs: np.ndarray, number: np.ndarray) -> np.ndarray:
    """Slots whose value stands for several values of the other side; several numbers may become one if all of them change."""
    forth, back = {}, {}
    for m, t, n in zip(mine.tolist(), theirs.tolist(), number.tolist()):
        forth.setdefault(m, set()).add(t)
        back.setdefault(t, set()).add((m, n))
    free = {t for t, found in back.items() if all(n and m != t for m, n in found)}
    return np.array([len(forth[m]) > 1 or (t not in free and len({x for x, _ in back[t]}) > 1) for m, t in zip(mine.tolist(), theirs.tolist())], bool)


def _alignments(tokens: Reading, theirs: Reading, by_width: dict) -> Iterator[tuple[int, int, int, np.ndarray, np.ndarray]]:
    """text, item, shift, and the places and widths of the item's windows that lie at that shift."""
    rows = list(_meetings(tokens, by_width))
    if not rows:
        return
    at, item, place, width = map(np.concatenate, zip(*rows))
    if not len(at):
        return
    text = tokens.items(at)
    shift = at - place  # equal for the windows of one alignment
    order = np.lexsort((place, shift, item, text))
    item, place, width, text, shift = (x[order] for x in (item, place, width, text, shift))
    new = np.flatnonzero(np.concatenate([[True], (np.diff(text) != 0) | (np.diff(item) != 0) | (np.diff(shift) != 0)]))
    for a, b in zip(new, np.append(new[1:], len(text))):
        yield int(text[a]), int(item[a]), int(shift[a]), place[a:b], width[a:b]


def find_items(texts: Texts, index: Index, rule: Rule) -> dict[int, list[tuple[int, float, bool]]]:
    """text -> (item, coverage, verbatim) of every item found in it."""
    tokens = canonical(texts, rule)
    covered: dict[tuple[int, int], set[int]] = {}
    changed: set[tuple[int, int]] = set()
    clashes: dict[tuple[int, int], dict[int, list[int]]] = {}  # by distance of the words, of names inside sentences and numbers

    for k in (1, 2, 0) if tokens.readings and index.tokens.readings else ():
        here, there = tokens.readings[k], index.tokens.readings[k]
        for text, item, shift, place, width in _alignments(here, there, index.by_width[k]):
            key, base = (text, item), int(there.first[item])
            if k:
                places = np.unique(np.concatenate([np.arange(p, p + w) for p, w in zip(place, width)]))
                places = places[there.kind[base + places] != LITERAL]
                mine, theirs = there.value[base + places], here.value[shift + places]
                clash = _conflicts(mine, theirs, there.kind[base + places] == NUMBER)
                bad, other = places[clash], places[mine != theirs]
                if k == 1:
                    for x, y in zip(there.word[base + bad].tolist(), here.word[shift + bad].tolist()):
                        clashes.setdefault(key, {}).setdefault(y - x, []).append(x)
            else:
                bad = np.sort(np.array(clashes.get(key, {}).get(shift - base, []), np.int64)) - base
                other = bad[:0]
            good = np.searchsorted(bad, place) == np.searchsorted(bad, place + width)
            for p, w in zip(place[good], width[good]):
                covered.setdefault(key, set()).update(range(int(there.word[base + p]), int(there.word[base + p + w])))
            if len(bad) or (np.searchsorted(other, place[good]) < np.searchsorted(other, (place + width)[good])).any():
                changed.add(key)
    sizes, out = np.diff(index.tokens.words), {}
    for (t, i), places in sorted(covered.items()):
        if len(places) >= rule.coverage * sizes[i]:
            out.setdefault(t, []).append((i, len(places) / float(sizes[i]), (t, i) not in changed))
    return out


HIT = T.ArrayType(T.StructType([T.StructField("item_id", T.LongType()), T.StructField("coverage", T.DoubleType()),
                                T.StructField("verbatim", T.BooleanType())]))
ARROW_HITS = pa.list_(pa.struct([("item_id", pa.int64()), ("coverage", pa.float64()), ("verbatim", pa.bool_())]))


def _blocks(items: DataFrame) -> Iterator[tuple[list[int | None], list[str | None]]]:
    """Items in blocks of bounded size; a block is one query set."""
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = -(-size // BLOCK_BYTES)
    keyed = items.select("item_id", "text", F.pmod(F.xxhash64("item_id", "text"), F.lit(max(n, 1))).alias("block"))
    for k in range(n):
        rows = keyed.filter(F.col("block") == k).orderBy("item_id", "text").collect()
        yield [r.item_id for r in rows], [r.text for r in rows]


def _blocks_of_hits(rows: DataFrame, key: str, text: str, items: DataFrame, rule: Rule) -> DataFrame:
    """``key`` and hits of the rows that hold an item; every block of items is a job, and is given up after it."""
    schema = T.StructType([rows.schema[key], T.StructField("hits", HIT)])
    path = scratch_path(rows.sparkSession, "hits")
    for ids, texts in _blocks(items):
        index = rows.sparkSession.sparkContext.broadcast(build_index(texts, rule))

        def work(batches: Iterable[pa.RecordBatch], ids=ids, index=index) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for part, block in parts_of(batch, 1):
                    found = find_items(block, index.value, rule)
                    places = pa.array(list(found), pa.int64())
                    yield pa.RecordBatch.from_arrays([part.column(0).take(places), _as_hits(found.values(), ids)], names=[key, "hits"])

        rows.select(key, text).mapInArrow(work, schema).write.mode("append").parquet(path)
        index.destroy()
    hits = rows.sparkSession.read.schema(schema).parquet(path)
    return materialise(hits.groupBy(key).agg(F.array_sort(F.flatten(F.collect_list("hits"))).alias("hits")), "hits-by-row")


def _as_hits(found: Iterable[list[tuple[int, float, bool]]], ids: list[int | None]) -> pa.Array:
    return pa.array([[{"item_id": ids[i], "coverage": c, "verbatim": v} for i, c, v in hits] for hits in found], ARROW_HITS)


def find_contamination(docs: DataFrame, items: DataFrame, rule: Rule = Rule(), text: str = "text") -> DataFrame:
    """``docs`` with ``hits``: the benchmark items (item_id, text) found in each document."""
    docs = docs.drop("hits") if "hits" in docs.columns else docs
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    if size == 0:
        return docs.withColumn("hits", F.array().cast(HIT))
    if size > BLOCK_BYTES:
        key = "_row"
        while key in docs.columns:
            key = f"_{key}"
        rows = materialise(docs.withColumn(key, F.monotonically_increasing_id()), "numbered")
        hits = _blocks_of_hits(rows, key, text, items, rule)
        return rows.join(hits, key, "left").withColumn("hits", F.coalesce("hits", F.array().cast(HIT))).drop(key)
    names = [*docs.columns, "hits"]
    at = names.index(text)
    schema = T.StructType([*docs.schema.fields, T.StructField("hits", HIT)])
    ids, texts = next(_blocks(items))
    index = docs.sparkSession.sparkContext.broadcast(build_index(texts, rule))

    def work(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, block in parts_of(batch, at):
                found = find_items(block, index.value, rule)
                hits = _as_hits((found.get(t, []) for t in range(part.num_rows)), ids)
                yield pa.RecordBatch.from_arrays([*part.columns, hits], names=names)

    return docs.mapInArrow(work, schema)
