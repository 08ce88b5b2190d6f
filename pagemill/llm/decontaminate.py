"""Benchmark decontamination: CGK embedding, bit-sampling LSH, exact edit verification.

Texts are sequences of words: what white space parts, in lower case, without anything that is no letter or
digit; in scripts that are written without spaces each character is a word.  A document is contaminated by an
item of n words when some stretch of it is within ``floor(rate * n)`` word edits (insert, delete, replace) of
the whole item.  Items of fewer than ``min_words`` words, which a few edits would make match clean texts, count
where all their words stand one after the other.

The CGK embedding reads a window by a random walk: at step j it writes the word it stands on and goes on by
one if a random bit of (j, word) is 1.  Windows that are a few edits apart then agree at many steps, so edit
distance turns into Hamming distance, and sampling steps is an LSH for it: a repeat draws ``coordinates`` steps,
and windows that agree at all of them are a candidate.  ``repeats`` follows from ``target_recall``, given that
related windows agree at a step with probability ``agreement``; every coordinate is drawn anew for each repeat,
and ``SAMPLES`` repeats share the walks of one embedding.

Items are taken in classes of like size, from ``low`` to ``2 * low - 1`` words; the walk of a class takes
``low / 2`` steps, ``MAX_STEPS`` at most.  Windows start at every word of an item and at every ``low / 4``-th word of the documents,
from another first word for each embedding, so an occurrence is met by several windows in each repeat, and not
by the same ones in all.  Windows whose sampled steps stand on fewer than three words of the item tell too
little and are left out.  tests/llm measures recall at the edit limit for each size and kind of edit.

Candidates whose words can't reach the item's are dropped by counting; the rest are compared by Myers'
bit-parallel edit distance in full.  Words of no item are one symbol: they match nothing either way.

Items go to the executors in blocks of at most ``WORDS_A_BLOCK`` words (or one item); each block is held against
all documents.

Defined results: a null or empty text has no hits; an item without a word takes no part; repeated rows and items
get their rows each; null ids are carried along; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bounded_batches
from .tokens import text_parts
from .worker import keep

RATE = 0.2
MIN_WORDS = 8
COORDINATES = 4
AGREEMENT = 0.65
TARGET_RECALL = 0.97
#: Repeats that sample the steps of one embedding.
SAMPLES = 3
#: Steps of a walk at most: two walks that an edit has set apart drift, and long ones would seldom agree at their ends.
MAX_STEPS = 32
WORDS_A_BLOCK = 250_000
#: Different raw words a worker remembers before it starts anew.
MAX_WORDS = 500_000
#: Candidates counted at a time.
MAX_COUNTED = 1 << 16
_OTHER = re.compile(r"[\W_]+")
#: Thai, Lao, Burmese, Khmer, kana and Han.
_UNSPACED = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff]")


def repeats_for(target: float, agreement: float = AGREEMENT, coordinates: int = COORDINATES) -> int:
    return max(1, math.ceil(math.log(1 - target) / math.log(1 - agreement**coordinates)))


def raw_words(text: str) -> list[str]:
    if not text.isascii() and _UNSPACED.search(text):
        text = _UNSPACED.sub(lambda c: f" {c[0]} ", text)
    return text.split()


def plain(word: str) -> str:
    return _OTHER.sub("", word).lower()


class _Symbols(dict):
    """Raw word -> symbol: 0 for words of no item, -1 for what is no word."""

    def __init__(self, known: dict[str, int]):
        super().__init__()
        self.known = known

    def __missing__(self, raw: str) -> int:
        word = plain(raw)
        symbol = self.known.get(word, 0) if word else -1
        if len(self) > MAX_WORDS:
            self.clear()
        self[raw] = symbol
        return symbol


def edits(places: dict[int, int], m: int, text: list[int]) -> tuple[int, int]:
    """Least edit distance of a pattern of ``m`` words to any stretch of ``text``, and where the first best stretch ends."""
    full, top = (1 << m) - 1, 1 << (m - 1)
    up, down, score, best, end = full, 0, m, m, -1
    for at, symbol in enumerate(text):
        equal = places.get(symbol, 0)
        vertical = equal | down
        across = (((equal & up) + up) ^ up) | equal
        more, less = down | ~(across | up) & full, up & across
        score += bool(more & top) - bool(less & top)
        more, less = more << 1 & full, less << 1 & full
        up, down = less | ~(vertical | more) & full, more & vertical
        if score < best:
            best, end = score, at
    return best, end


_ODD = np.uint64(0x9E3779B97F4A7C15)


class _Repeat:
    """Items' windows under the words at one draw of steps."""

    def __init__(self, steps: tuple[int, ...], symbols: list[np.ndarray], item: np.ndarray, shift: np.ndarray):
        self.steps = steps
        self.first = np.zeros(0, bool)
        if not len(item):
            return
        self.first = np.zeros(int(symbols[0].max()) + 1, bool)
        self.first[symbols[0]] = True
        self.room = np.uint64(64 - min(22, max(14, len(item).bit_length() + 4)))
        self.second = np.zeros(1 << (64 - int(self.room)), bool)
        keys = symbols[0].astype(np.uint64)
        for k, s in enumerate(symbols[1:]):
            keys = self._joined(keys, s)
            if not k:
                self.second[(keys >> self.room).astype(np.int64)] = True
        order = np.argsort(keys, kind="stable")
        self.item, self.shift = item[order].astype(np.int32), shift[order].astype(np.int32)
        self.keys, begin = np.unique(keys[order], return_index=True)
        self.begin = np.append(begin, len(order))

    @staticmethod
    def _joined(key: np.ndarray, symbol: np.ndarray) -> np.ndarray:
        return (key * _ODD + symbol.astype(np.uint64) + np.uint64(1)) * _ODD

    def found(self, x: np.ndarray, starts: np.ndarray, at: dict[int, np.ndarray]) -> np.ndarray:
        """(item, where it would start) of the windows at ``starts``."""
        if not len(self.first):
            return np.zeros((2, 0), np.int64)
        symbol = x[at[self.steps[0]]]
        alive = np.flatnonzero(self.first[np.minimum(symbol, len(self.first) - 1)] & (symbol < len(self.first)))
        key = symbol[alive].astype(np.uint64)
        for k, step in enumerate(self.steps[1:]):
            key = self._joined(key, x[at[step][alive]])
            if not k:
                likely = self.second[(key >> self.room).astype(np.int64)]
                alive, key = alive[likely], key[likely]
        place = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        right = self.keys[place] == key
        own, place = starts[alive[right]], place[right]
        low, many = self.begin[place], self.begin[place + 1] - self.begin[place]
        listed = np.repeat(low - (np.cumsum(many) - many), many) + np.arange(int(many.sum()))
        return np.stack([self.item[listed].astype(np.int64), np.repeat(own, many) - self.shift[listed]])


def walk(x: np.ndarray, starts: np.ndarray, bits: list[np.ndarray], wanted: set[int]) -> dict[int, np.ndarray]:
    """Where the walks from ``starts`` stand at the wanted steps.  ``bits``: for every place of ``x`` its word's random bits, 64 steps each."""
    at, out = starts, {}
    for step in range(max(wanted) + 1):
        if step in wanted:
            out[step] = at
        at = at + (bits[step // 64][at] >> np.uint64(step % 64) & np.uint64(1)).astype(at.dtype)
    return out


class Index:
    """Items' windows under their sampled steps, for each repeat and size class."""

    def __init__(self, items: list[tuple], rate: float, min_words: int, coordinates: int, repeats: int):
        split = [(i, [w for w in map(plain, raw_words(t or "")) if w]) for i, t in items]
        split = [(i, w) for i, w in split if w]
        self.known: dict[str, int] = {}
        self.ids, self.words = [i for i, _ in split], [[self.known.setdefault(x, len(self.known) + 1) for x in w] for _, w in split]
        self.size = [len(w) for w in self.words]
        self.most = [math.floor(rate * n) if n >= min_words else 0 for n in self.size]
        self.places: list[dict[int, int]] = []
        for w in self.words:
            p: dict[int, int] = {}
            for k, x in enumerate(w):
                p[x] = p.get(x, 0) | 1 << k
            self.places.append(p)
        self.n_symbols = len(self.known) + 1
        self.symbols = _Symbols(self.known)
        owner = np.repeat(np.arange(len(self.size)), self.size)
        self.held = np.unique(owner * self.n_symbols + np.array([x for w in self.words for x in w], np.int64)) if self.size else np.zeros(0, np.int64)
        groups: dict[int, list[int]] = {}
        for k, n in enumerate(self.size):
            # items that have to stand whole are looked up by all their words
            groups.setdefault(1 << (n.bit_length() - 1) if self.most[k] else -n, []).append(k)
        self.whole = [self._repeat(tuple(range(-n)), members) for n, members in sorted(groups.items()) if n < 0]
        self.classes = [(low, members) for low, members in sorted(groups.items()) if low > 0]
        draw = np.random.default_rng(711)
        self.embeddings = []
        self.most_steps = max((self._steps(low) for low, _ in self.classes), default=0)
        for e in range(-(-repeats // SAMPLES)):
            bits = draw.integers(0, 1 << 64, size=(-(-self.most_steps // 64), self.n_symbols), dtype=np.uint64)
            n = min(SAMPLES, repeats - e * SAMPLES)
            self.embeddings.append((bits, [self._class(low, members, coordinates, n, e, bits, draw) for low, members in self.classes]))

    @staticmethod
    def _steps(low: int) -> int:
        return max(6, min(low // 2, MAX_STEPS))

    def _flat(self, members):
        """The members' words, and for each of them the item, the place in it and the item's end."""
        size = np.array([self.size[k] for k in members])
        flat = np.array([x for k in members for x in self.words[k]], np.int32)
        begin = np.repeat(np.cumsum(size) - size, size)
        return flat, np.repeat(np.array(members), size), np.arange(len(flat)) - begin, begin + np.repeat(size, size)

    def _repeat(self, steps, members):
        """A repeat that reads its words in a row, from the first one of each item."""
        flat, item, shift, _ = self._flat(members)
        start = np.flatnonzero(shift == 0)
        return _Repeat(steps, [flat[start + s] for s in steps], item[start], shift[start])

    def _class(self, low, members, coordinates, samples, embedding, bits, draw):
        flat, item, shift, end = self._flat(members)
        n_steps, stride = self._steps(low), max(1, low // 4)
        padded = np.concatenate([flat, np.zeros(n_steps + 1, np.int32)])
        drawn = [tuple(sorted(draw.choice(n_steps, min(coordinates, n_steps), replace=False).tolist())) for _ in range(samples)]
        wanted = {s for steps in drawn for s in steps}
        at = walk(padded, np.arange(len(flat)), [b[padded] for b in bits], wanted)
        repeats = []
        for steps in drawn:
            places = np.stack([at[s] for s in steps])
            tells = (places[-1] < end) & (1 + (np.diff(places, axis=0) > 0).sum(axis=0) >= min(3, coordinates))
            repeats.append(_Repeat(steps, [padded[p[tells]] for p in places], item[tells], shift[tells]))
        return stride, embedding * 0.6180339887 % 1, wanted, repeats

    def candidates(self, x: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """Items and the places where they would start in the ``n`` symbols at the head of ``x``; what follows them is padding."""
        found = [np.zeros((2, 0), np.int64)]
        if self.whole:
            starts = np.flatnonzero(x[:n])
            found += [repeat.found(x, starts, {s: starts + s for s in repeat.steps}) for repeat in self.whole]
        for bits, classes in self.embeddings:
            own = [b[x] for b in bits]
            for stride, phase, wanted, repeats in classes:
                starts = np.arange(int(phase * stride), n, stride)
                at = walk(x, starts, own, wanted)
                found += [repeat.found(x, starts, at) for repeat in repeats]
        item, start = np.concatenate(found, axis=1)
        room, least = n + 2 * max(self.size), max(self.size)
        item, start = np.divmod(np.unique(item * room + start + least), room)
        start = start - least
        parts = [self._possible(x, n, item[k : k + MAX_COUNTED], start[k : k + MAX_COUNTED]) for k in range(0, len(item), MAX_COUNTED)]
        return tuple(np.concatenate(p) for p in zip(*parts, strict=True)) if parts else (item, start)

    def _possible(self, x, n, item, start):
        """Those whose stretch holds enough of the item's words, counted without order."""
        size, most = np.array(self.size)[item], np.array(self.most)[item]
        low, high = np.clip(start - most, 0, n), np.clip(start + size + 2 * most, 0, n)
        many = high - low
        begin = np.cumsum(many) - many
        place = np.repeat(low - begin, many) + np.arange(int(many.sum()))
        code = np.repeat(item, many) * self.n_symbols + x[place]
        where = np.minimum(np.searchsorted(self.held, code), max(0, len(self.held) - 1))
        seen = np.concatenate([[0], np.cumsum(self.held[where] == code)]) if len(self.held) else np.zeros(1, np.int64)
        enough = seen[begin + many] - seen[begin] >= size - most
        return item[enough], start[enough]

    def hits(self, texts: list[str]) -> list[tuple[int, int, int, int]]:
        """(text, item, word where it starts about, edits), the best of each text and item."""
        symbols = [np.fromiter(map(self.symbols.__getitem__, words), np.int32, len(words)) for words in map(raw_words, texts)]
        symbols = [s[s >= 0] for s in symbols]
        ends = np.cumsum([len(s) for s in symbols])
        n = int(ends[-1]) if len(symbols) else 0
        if not n or not self.size:
            return []
        pad = max(max(self.size), self.most_steps) + 1
        x = np.concatenate([*symbols, np.zeros(pad, np.int32)])
        found = []
        for doc, item, a, b in zip(*(c.tolist() for c in self._stretches(ends, *self.candidates(x, n))), strict=True):
            distance, end = edits(self.places[item], self.size[item], x[a:b].tolist())
            if distance <= self.most[item]:
                found.append((doc, item, distance, max(0, a + end + 1 - self.size[item] - (int(ends[doc - 1]) if doc else 0))))
        best: dict[tuple[int, int], tuple[int, int]] = {}
        for doc, item, distance, at in found:
            best[doc, item] = min((distance, at), best.get((doc, item), (1 << 30, 0)))
        return [(d, item, at, distance) for (d, item), (distance, at) in sorted(best.items())]

    def _stretches(self, ends, item, start):
        """doc, item, and from where to where in the symbols: a text's overlapping candidates of an item are one stretch."""
        size, most = np.array(self.size)[item], np.array(self.most)[item]
        # the middle of the item lies in the text that holds it, but a text may end within the item's allowed edits
        docs = np.stack([np.searchsorted(ends, np.maximum(start, 0) + half, side="right") for half in (size // 2, 0)])
        doc, (item, start, size, most) = docs.ravel(), (np.tile(c, 2) for c in (item, start, size, most))
        inside = doc < len(ends)
        doc, item, start, size, most = (c[inside] for c in (doc, item, start, size, most))
        a, b = np.maximum(np.concatenate([[0], ends])[doc], start - most), np.minimum(ends[doc], start + size + 2 * most)
        order = np.lexsort((a, item, doc))
        order = order[(b - a >= size - most)[order]]
        doc, item, a, b = doc[order], item[order], a[order], b[order]
        new = np.ones(len(doc), bool)
        new[1:] = (doc[1:] != doc[:-1]) | (item[1:] != item[:-1]) | (a[1:] > b[:-1])
        last = np.append(new[1:], True)[: len(new)]
        return doc[new], item[new], a[new], b[last]


def _index(shared, *options) -> Index:
    """This worker's index of a block of items."""
    items = shared.value
    return keep(("index", hash(tuple(items)), options), lambda: Index(items, *options))


def blocks_of(benchmark: DataFrame, item_col: str, text_col: str, most: int) -> Iterator[list[tuple]]:
    """The items in blocks of at most ``most`` words or one item, in the order of their ids."""
    rows = benchmark.select(F.col(f"`{item_col}`").alias("item"), F.col(f"`{text_col}`").alias("text")).orderBy("item", "text")
    block: list[tuple] = []
    room = most
    for row in rows.toLocalIterator():
        n = len(raw_words(row.text or ""))
        if block and n > room:
            yield block
            block, room = [], most
        block.append(tuple(row))
        room -= n
    if block:
        yield block


def _options(rate, min_words, coordinates, target_recall):
    return rate, min_words, coordinates, repeats_for(target_recall, coordinates=coordinates)


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    rate: float = RATE,
    min_words: int = MIN_WORDS,
    coordinates: int = COORDINATES,
    target_recall: float = TARGET_RECALL,
    words_a_block: int = WORDS_A_BLOCK,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """One row a document and item it holds: doc_id, item_id, at_word, n_words (the item's), edits."""
    bounded_batches(docs.sparkSession)
    spark, options = docs.sparkSession, _options(rate, min_words, coordinates, target_recall)
    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    item_type = dict(benchmark.dtypes)[item_col]
    schema = f"doc_id {dict(rows.dtypes)['doc_id']}, item_id {item_type}, at_word long, n_words long, edits long"

    def finder(shared):
        def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            index = _index(shared, *options)
            for batch in batches:
                for _, part, texts in text_parts(batch):
                    hits = index.hits([t or "" for t in texts])
                    docs_hit = part.column(0).take(pa.array([h[0] for h in hits], pa.int64()))
                    items = pa.array([index.ids[h[1]] for h in hits])
                    counts = [pa.array(c, pa.int64()) for c in ([h[2] for h in hits], [index.size[h[1]] for h in hits], [h[3] for h in hits])]
                    if hits:
                        yield pa.RecordBatch.from_arrays([docs_hit, items, *counts], ["doc_id", "item_id", "at_word", "n_words", "edits"])

        return find

    found = None
    for block in blocks_of(benchmark, item_col, item_text_col, words_a_block):
        part = rows.mapInArrow(finder(spark.sparkContext.broadcast(block)), schema)
        found = part if found is None else found.unionByName(part)
    return found if found is not None else spark.createDataFrame([], schema)


def clean(docs: DataFrame, benchmark: DataFrame, rate: float = RATE, min_words: int = MIN_WORDS, coordinates: int = COORDINATES, target_recall: float = TARGET_RECALL, words_a_block: int = WORDS_A_BLOCK, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """The documents that hold no item, as they came; nothing is shuffled."""
    bounded_batches(docs.sparkSession)
    spark, options, at = docs.sparkSession, _options(rate, min_words, coordinates, target_recall), docs.columns.index(text_col)

    def keeper(shared):
        def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            index = _index(shared, *options)
            for batch in batches:
                stays = np.ones(batch.num_rows, bool)
                for first, _, texts in text_parts(batch, at):
                    stays[[first + h[0] for h in index.hits([t or "" for t in texts])]] = False
                yield batch.filter(pa.array(stays))

        return keep

    for block in blocks_of(benchmark, item_col, item_text_col, words_a_block):
        docs = docs.mapInArrow(keeper(spark.sparkContext.broadcast(block)), docs.schema)
    return docs
