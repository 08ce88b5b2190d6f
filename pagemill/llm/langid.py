"""Language identification by segmentation-marginalised unigrams.

Each language has a probability for each piece of a fixed public vocabulary.  A word's likelihood is the
sum over all its segmentations into pieces, by the forward algorithm; pieces don't cross white space, so a
text's likelihood is the product over its words and a word seen before costs a look-up.

Learning: expectation-maximisation over the words of a sample of labelled texts, at most ``sample_texts``
different texts a language, those of the least hash over all labelled rows.  Ids play no part in the draw, and
a text that is repeated counts once, however often.  The words of the sample are counted on the executors;
each language is fitted in a task of its own.  What is kept a language is one number a piece.

Scoring reads whole texts.  The score is the posterior of the best language after the log-likelihoods are
divided by the square root of the number of words, which keeps long texts from all scoring 1.

As a pipeline stage (``keep_identified``) the predicted language becomes the document's ``lang``; documents
without a language go, and so do those of a language that isn't asked for.

Every piece of the vocabulary takes part but single bytes and control pieces; words of over ``LONG`` characters
are scored, but aren't learned from.

Defined results: null texts and texts without a letter are ``und`` with score 0; with no labelled row at all
every text is, and the stage then keeps every document as it came, as nothing can be told apart; ties go to
the first language by name; null ids and repeated rows get their rows; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Collection, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import bounded_batches
from .shingles import mix
from .tokens import text_parts
from .worker import drop, keep

SAMPLE_TEXTS = 400
ROUNDS = 3
#: Words remembered by a worker before it starts anew.
MAX_WORDS = 500_000
#: Words of more characters are scored one by one, with the sums kept in range.
LONG = 40
SPACE = "▁"
#: Stripped from both ends of a word before it is scored.
MARKS = ".,;:!?\"'()[]{}<>*_-–—…«»„“”‘’/\\|#&%$0123456789"
_BASE = 0x9E3779B97F4A7C15
_LETTER = re.compile(r"[^\W\d_]")


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def pieces(path: str) -> list[str]:
    """The vocabulary's pieces in lower case, each once; single bytes and control pieces are left out."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    n = model.get_piece_size()
    plain = (model.id_to_piece(i) for i in range(n) if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i)))
    return sorted({p.lower() for p in plain})


def words_of(text: str) -> list[str]:
    return text.lower().split()


class Lattice:
    """Finds the pieces within words, for many words at once, by rolling hashes."""

    def __init__(self, vocabulary: list[str]):
        self.unknown = len(vocabulary)  # stands for a character that no piece holds
        self.longest = max(map(len, vocabulary), default=1)
        chars, size = self._chars(vocabulary)
        sums, down = self._prefixes(chars)
        end = np.cumsum(size)
        keys = (sums[end] - sums[end - size]) * down[end - size]
        self.order = np.argsort(keys)
        self.keys = keys[self.order]

    @staticmethod
    def _chars(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        return np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32), np.fromiter(map(len, words), np.int64, len(words))

    @staticmethod
    def _prefixes(chars: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sums of a polynomial hash over ``chars``, and the factors that shift a stretch back to its start."""
        sums = np.zeros(len(chars) + 1, np.uint64)
        up = np.full(len(chars) + 1, _BASE, np.uint64)
        down = np.full(len(chars) + 1, pow(_BASE, -1, 1 << 64), np.uint64)
        up[0] = down[0] = 1
        up, down = np.multiply.accumulate(up), np.multiply.accumulate(down)
        np.cumsum(mix(chars.astype(np.uint64) + np.uint64(1)) * up[:-1], out=sums[1:])
        return sums, down

    def edges(self, words: list[str]) -> tuple[np.ndarray, list[tuple[int, int, np.ndarray, np.ndarray]]]:
        """The marked words' sizes, and (end, length, words, pieces): which words have which piece there, by rising end."""
        chars, size = self._chars([SPACE + w for w in words])
        begin = np.cumsum(size) - size
        sums, down = self._prefixes(chars)
        out = []
        for end in range(1, int(size.max()) + 1 if len(size) else 1):
            active = np.flatnonzero(size >= end)
            at = begin[active] + end
            for length in range(1, min(end, self.longest) + 1):
                key = (sums[at] - sums[at - length]) * down[at - length]
                place = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
                right = self.keys[place] == key
                if length == 1:
                    out.append((end, 1, active, np.where(right, self.order[place], self.unknown)))
                elif right.any():
                    out.append((end, length, active[right], self.order[place[right]]))
        return size, out


def forward(size: np.ndarray, edges, prob: np.ndarray) -> np.ndarray:
    """ahead[end, word, ...]: the sum over all segmentations of the word's first ``end`` characters.  prob: piece -> number(s)."""
    ahead = np.zeros((int(size.max()) + 1, len(size), *prob.shape[1:]))
    ahead[0] = 1.0
    for end, length, own, piece in edges:
        ahead[end, own] += ahead[end - length, own] * prob[piece]
    return ahead


def fit(counts: dict[str, int], vocabulary: list[str], rounds: int = ROUNDS) -> np.ndarray:
    """Piece probabilities (the last is that of an unknown character) from word counts, by expectation-maximisation."""
    n, words = np.fromiter(counts.values(), float, len(counts)), np.arange(len(counts))
    size, edges = Lattice(vocabulary).edges(list(counts))
    # longer pieces are likelier to be words' own parts, so the first segmentations favour them
    prob = np.array([2.0 ** len(p) for p in vocabulary] + [1.0])
    prob /= prob.sum()
    for _ in range(rounds if len(words) else 0):
        ahead = forward(size, edges, prob)
        whole = ahead[size, words]
        # words too long for the range of a double tell little
        weight = np.divide(n, whole, out=np.zeros_like(n), where=whole > 1e-280)
        back, expected = np.zeros_like(ahead), np.zeros(len(prob))
        back[size, words] = 1.0
        for end, length, own, piece in reversed(edges):
            share = back[end, own] * prob[piece]
            back[end - length, own] += share
            expected += np.bincount(piece, weight[own] * ahead[end - length, own] * share, len(prob))
        prob = expected + 0.05
        prob /= prob.sum()
    return prob


class _Rows(dict):
    """Word -> its row; a new word gets one and is queued."""

    def __init__(self):
        super().__init__()
        self.queue: list[str] = []

    def __missing__(self, word: str) -> int:
        self.queue.append(word)
        self[word] = row = len(self.queue) - 1
        return row


class Scorer:
    """Log-likelihoods of texts, for all languages at once."""

    def __init__(self, vocabulary: list[str], probabilities: np.ndarray):
        self.number = {p: i for i, p in enumerate(vocabulary)}
        self.lattice = Lattice(vocabulary)
        self.prob = np.ascontiguousarray(probabilities.T)  # piece -> a probability for each language
        self.n = probabilities.shape[0]
        self._reset()

    def _reset(self) -> None:
        self.rows, self.logs = _Rows(), np.zeros((0, self.n))

    def forward(self, words: list[str]) -> np.ndarray:
        """Each word's log-likelihoods.  Words of up to LONG characters."""
        size, edges = self.lattice.edges(words)
        return np.log(forward(size, edges, self.prob)[size, np.arange(len(words))])

    def long_word(self, word: str) -> np.ndarray:
        """The same for one word of any length, with the sums kept in range."""
        unknown = len(self.number)
        ahead, lost = [np.ones(self.n)], np.zeros(self.n)
        marked = SPACE + word
        for end in range(1, len(marked) + 1):
            now = np.zeros(self.n)
            for length in range(1, min(end, self.lattice.longest) + 1):
                k = self.number.get(marked[end - length : end], unknown if length == 1 else None)
                if k is not None:
                    now = now + ahead[-length] * self.prob[k]
            ahead.append(now)
            ahead = ahead[-self.lattice.longest :]
            if now.min() < 1e-150:
                top = np.max(ahead, axis=0)
                ahead, lost = [a / top for a in ahead], lost + np.log(top)
        return np.log(ahead[-1]) + lost

    def _learn(self) -> None:
        known = len(self.logs)
        new = self.rows.queue[known:]
        if not new:
            return
        bare = [w.strip(MARKS) for w in new]
        at = {w: k for k, w in enumerate(dict.fromkeys(w for w in bare if w))}
        logs = np.zeros((len(at) + 1, self.n))  # the last is for words of marks only
        words = np.array(list(at), object)
        short = np.array([len(w) <= LONG for w in words], bool)
        for first in range(0, len(words), 10_000):
            chosen = np.flatnonzero(short[first : first + 10_000]) + first
            if len(chosen):
                logs[chosen] = self.forward(words[chosen].tolist())
        for k in np.flatnonzero(~short):
            logs[k] = self.long_word(words[k])
        self.logs = np.concatenate([self.logs, logs[[at.get(w, -1) for w in bare]]])

    def texts(self, texts: list[str]) -> list[tuple[np.ndarray, int]]:
        """Each text's log-likelihoods and number of words."""
        if len(self.rows) > MAX_WORDS:
            self._reset()
        rows = [np.fromiter(map(self.rows.__getitem__, w), np.int64, len(w)) for w in map(words_of, texts)]
        self._learn()
        return [(self.logs[r].sum(axis=0), len(r)) for r in rows]


def predictions(scorer: Scorer | None, names: list[str], texts: list[str | None]) -> tuple[list[str], list[float]]:
    """The best language and its score for each text."""
    best, score = ["und"] * len(texts), [0.0] * len(texts)
    if scorer is None:
        return best, score
    able = [k for k, t in enumerate(texts) if t is not None and _LETTER.search(t)]
    chosen = [texts[k] for k in able]
    for k, (total, n) in zip(able, scorer.texts(chosen) if chosen else (), strict=True):
        odds = np.exp((total - total.max()) / math.sqrt(n))
        best[k], score[k] = names[int(total.argmax())], float(odds.max() / odds.sum())
    return best, score


def sample(docs: DataFrame, learn: Column, most: int, text_col: str, lang_col: str) -> DataFrame:
    """lang and text of at most ``most`` different texts a language, those of the least hash; ties go by the text."""
    lang, text = F.col(f"`{lang_col}`").cast("string"), F.col(f"`{text_col}`").cast("string")
    labelled = docs.where(learn).select(lang.alias("lang"), text.alias("text"), F.xxhash64(text).alias("o")).where("lang IS NOT NULL AND text IS NOT NULL")
    # a share of the hashes that holds twice as many different texts as asked for, so that few are moved and none is lost
    counts = labelled.groupBy("lang").agg(F.approx_count_distinct("o").alias("n"))
    bound = counts.select(F.col("lang").alias("b_lang"), F.least(F.lit(1.0), F.lit(2.0 * most + 100) / F.col("n")).alias("share"))
    # one row a language
    near = labelled.join(F.broadcast(bound), F.col("lang") == F.col("b_lang")).where(F.col("o") <= -(2.0**63) + F.col("share") * 2.0**64)
    return near.select("lang", "o", "text").distinct().withColumn("r", F.row_number().over(Window.partitionBy("lang").orderBy("o", "text"))).where(F.col("r") <= most).select("lang", "text")


def train(docs: DataFrame, learn: Column, text_col: str, lang_col: str, vocabulary: str, most: int, rounds: int) -> dict[str, list[float]]:
    """Language -> piece probabilities."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        drop()
        found: dict[str, Counter] = defaultdict(Counter)
        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found[lang].update(b for w in words_of(text) if (b := w.strip(MARKS)) and len(b) <= LONG and _LETTER.search(b))
        for lang, words in found.items():
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(words)), pa.array(list(words)), pa.array(list(words.values()), pa.int64())], ["lang", "word", "n"])

    def fit_one(key: tuple, table: pa.Table) -> pa.Table:
        counts = dict(zip(table.column("word").to_pylist(), table.column("n").to_pylist(), strict=True))
        prob = fit(counts, pieces(vocabulary), rounds)
        return pa.table({"lang": pa.array([key[0].as_py()]), "prob": pa.array([prob.tolist()])})

    words = sample(docs, learn, most, text_col, lang_col).mapInArrow(count, "lang string, word string, n long")
    words = words.groupBy("lang", "word").agg(F.sum("n").alias("n"))
    fitted = words.groupBy("lang").applyInArrow(fit_one, "lang string, prob array<double>")
    # one row a language, one number a piece
    return {r.lang: list(r.prob) for r in fitted.collect()}


def held_out(id_col: str = "doc_id") -> Column:
    """crc32(doc_id as text) mod 4 is 2; a null id is not held out."""
    return F.coalesce(F.pmod(F.crc32(F.encode(F.col(f"`{id_col}`").cast("string"), "UTF-8")), F.lit(4)) == 2, F.lit(False))


def _model(docs, id_col, text_col, lang_col, vocabulary, sample_texts, rounds):
    bounded_batches(docs.sparkSession)
    vocabulary = vocabulary or default_vocabulary()
    model = train(docs, ~held_out(id_col), text_col, lang_col, vocabulary, sample_texts, rounds)
    names = sorted(model)
    return names, docs.sparkSession.sparkContext.broadcast(np.array([model[n] for n in names])) if names else None, vocabulary


def language_id(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    vocabulary: str | None = None,
    sample_texts: int = SAMPLE_TEXTS,
    rounds: int = ROUNDS,
) -> DataFrame:
    """One row a document: doc_id, held_out, lang_pred, score."""
    apart = held_out(id_col)
    names, shared, vocabulary = _model(docs, id_col, text_col, lang_col, vocabulary, sample_texts, rounds)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _scorer(shared, vocabulary) if shared else None
        for batch in batches:
            for _, part, texts in text_parts(batch, 2):
                best, score = predictions(scorer, names, texts)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(best, pa.string()), pa.array(score, pa.float64())], ["doc_id", "held_out", "lang_pred", "score"])

    rows = docs.select(F.col(f"`{id_col}`").alias("doc_id"), apart.alias("held_out"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return rows.mapInArrow(predict, f"doc_id {dict(rows.dtypes)['doc_id']}, held_out boolean, lang_pred string, score double")


def keep_identified(
    docs: DataFrame,
    languages: Collection[str] | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    vocabulary: str | None = None,
    sample_texts: int = SAMPLE_TEXTS,
    rounds: int = ROUNDS,
) -> DataFrame:
    """The documents predicted to be in one of ``languages`` (None: in any), their ``lang`` the predicted one.

    Documents that are ``und`` go.  Without a labelled row nothing can be told, and all documents stay as they came.
    Nothing is shuffled.
    """
    names, shared, vocabulary = _model(docs, id_col, text_col, lang_col, vocabulary, sample_texts, rounds)
    if shared is None:
        return docs
    at, lang_at = docs.columns.index(text_col), docs.columns.index(lang_col)
    wanted = set(names) if languages is None else set(languages)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = _scorer(shared, vocabulary)
        for batch in batches:
            for _, part, texts in text_parts(batch, at):
                best, _ = predictions(scorer, names, texts)
                told = part.set_column(lang_at, part.schema.field(lang_at), pa.array(best, part.schema.field(lang_at).type))
                yield told.filter(pa.array([b in wanted for b in best], pa.bool_()))

    return docs.mapInArrow(keep, docs.schema)


def _scorer(shared, vocabulary: str) -> Scorer:
    """This worker's scorer of a model."""
    return keep(("scorer", hash(shared.value.tobytes()), vocabulary), lambda: Scorer(pieces(vocabulary), shared.value))
