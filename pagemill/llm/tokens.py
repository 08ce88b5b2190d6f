"""Token ids of whole texts by the ``tokenizers`` library.

A byte-level BPE splits a text into pre-tokens (runs of letters, of digits, of other characters, each with
at most one space before it, and runs of white space) and never merges across them.  So a text may be cut

* before white space that follows a character that isn't white space;
* before a full stop or comma that follows a letter or digit;

and the ids of the cuts put together are those of the whole text.  ``Encoder`` cuts there and has the library
encode each different unit once; text that repeats words, as prose does, then costs a look-up a word.
Strings of special tokens part a text first, as they do in the library, and get the library's ids; with
``specials_as_text`` they are ordinary text, so that no document can bring in an id that means something else.
A tokenizer with another pre-tokenizer or a normaliser gets whole texts.  tests/llm compares with plain encoding.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .worker import keep

#: White space after white space, or a mark after what is no letter or digit: such texts are cut with care.
_ODD = re.compile(r"[.,\s](?<=[\W_][.,]|\s\s)")
_CUT = re.compile(r"(?<=\S)(?=[ \n])")
#: White space within a unit, but for one space in front; units that have it are encoded by themselves.
_INNER = re.compile(r"(?<!\A)\s|\A[^\S ]|\A \Z|\A\Z")
#: Units that are encoded in one call.
_TOGETHER = 256

#: Units remembered by a worker before it forgets those that were used once, so that memory has a bound.
MAX_UNITS = 600_000


class _Places(dict):
    """Unit -> its number; a new one is numbered and queued.  ``spaced`` keys stand for what follows a space, but for those that start with a mark."""

    def __init__(self, owner: Encoder, spaced: bool):
        super().__init__()
        self.owner, self.spaced = owner, spaced

    def __missing__(self, unit: str) -> int:
        queue = self.owner.queue
        queue.append(" " + unit if self.spaced and unit[:1] not in ("\n", ".", ",") or not unit else unit)
        self[unit] = n = len(self.owner.count) + len(queue) - 1
        return n


class Encoder:
    def __init__(self, path: str, max_units: int = MAX_UNITS, specials_as_text: bool = False):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core; the library's threads would take others' and their memory
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = specials_as_text
        self.vocab = self.tokenizer.get_vocab_size()
        self.max_units = max_units
        made = json.loads(self.tokenizer.to_str())
        pre = made.get("pre_tokenizer") or {}
        feed = self.tokenizer.encode("\n", add_special_tokens=False).ids
        # what the cuts hold for
        plain = not any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in made["added_tokens"])
        self.cuts = plain and not made.get("normalizer") and pre.get("type") == "ByteLevel" and pre["use_regex"] and not pre["add_prefix_space"] and len(feed) == 1
        self.feed = feed[0] if feed else None
        self.special = {} if specials_as_text else {t["content"]: t["id"] for t in made["added_tokens"]}
        self.parts = re.compile("|".join(map(re.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        self._reset()

    def _reset(self) -> None:
        self.queue: list[str] = []  # units numbered, but not yet encoded
        self.plain, self.spaced = _Places(self, False), _Places(self, True)
        self.flat = np.zeros(0, np.uint32)
        self.start = np.zeros(0, np.int64)
        self.count = np.zeros(0, np.int64)
        self.used = np.zeros(0, np.int64)

    def _forget(self) -> None:
        """Keeps the units that were used more than once, at most half of what there is room for."""
        order = np.argsort(-self.used, kind="stable")[: self.max_units // 2]
        kept = np.sort(order[self.used[order] > 1])
        number = np.full(len(self.count), -1, np.int64)
        number[kept] = np.arange(len(kept))
        old, count = (self.plain, self.spaced), self.count[kept]
        flat = self.flat[np.repeat(self.start[kept] - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))]
        # halved, so that what is no longer used goes in time
        used = self.used[kept] // 2
        self._reset()
        self.start, self.count, self.flat, self.used = np.cumsum(count) - count, count, flat, used
        listed = number.tolist()
        for new, places in zip((self.plain, self.spaced), old, strict=True):
            new.update((unit, listed[n]) for unit, n in places.items() if listed[n] >= 0)

    def _numbers(self, text: str) -> np.ndarray:
        if _ODD.search(text):
            cuts = _CUT.split(text)
            return np.fromiter(map(self.plain.__getitem__, cuts), np.int64, len(cuts))
        first, *rest = text.replace("\n", " \n").replace(".", " .").replace(",", " ,").split(" ")
        found = np.empty(len(rest) + bool(first), np.int64)
        if first:
            found[0] = self.plain[first]
        found[bool(first) :] = np.fromiter(map(self.spaced.__getitem__, rest), np.int64, len(rest))
        return found

    def _encoded(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all units, and how many each has."""
        flat, count = [], []
        for first in range(0, len(units), 64 * _TOGETHER):
            parts = [units[k : k + _TOGETHER] for k in range(first, min(first + 64 * _TOGETHER, len(units)), _TOGETHER)]
            for part, e in zip(parts, self.tokenizer.encode_batch_fast(["\n".join(p) + "\n" for p in parts], add_special_tokens=False), strict=True):
                ids = np.array(e.ids, np.uint32)
                cut = np.flatnonzero(ids == self.feed)
                keep = np.ones(len(ids), bool)
                keep[cut] = False
                flat.append(ids[keep])
                count.append(np.diff(cut, prepend=-1) - 1)
                assert len(cut) == len(part)
        return np.concatenate(flat), np.concatenate(count)

    def _learn(self) -> None:
        new, self.queue = self.queue, []
        if not new:
            return
        count, ids = np.zeros(len(new), np.int64), {}
        # a line feed after a unit without white space but in front is a pre-token of its own, and so parts units
        alone = [k for k, u in enumerate(new) if _INNER.search(u)]
        joined = np.delete(np.arange(len(new)), alone)
        if len(joined):
            flat, many = self._encoded([new[k] for k in joined.tolist()] if alone else new)
            count[joined] = many
        for k, e in zip(alone, self.tokenizer.encode_batch_fast([new[k] for k in alone], add_special_tokens=False), strict=True):
            ids[k] = e.ids
            count[k] = len(e.ids)
        start = len(self.flat) + np.cumsum(count) - count
        own = np.empty(int(count.sum()), np.uint32)
        if len(joined):
            many, at = count[joined], start[joined] - len(self.flat)
            own[np.repeat(at - (np.cumsum(many) - many), many) + np.arange(int(many.sum()))] = flat
        for k, i in ids.items():
            own[start[k] - len(self.flat) :][: count[k]] = i
        self.start = np.concatenate([self.start, start])
        self.flat = np.concatenate([self.flat, own])
        self.count = np.concatenate([self.count, count])
        self.used = np.concatenate([self.used, np.zeros(len(count), np.int64)])

    def _whole(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of texts that the cuts don't hold for."""
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, np.uint32) for e in found]

    def _specials(self, text: str) -> list[np.ndarray]:
        """The ids of a text's parts, with those of special strings between them."""
        found = self.parts.findall(text)
        ids = self.encode(self.parts.split(text))
        out = [ids[0]]
        for special, rest in zip(found, ids[1:], strict=True):
            out += [np.array([self.special[special]], np.uint32), rest]
        return out

    def encode(self, texts: list[str], end_id: int | None = None) -> list[np.ndarray]:
        """The ids of each text as uint32, with ``end_id`` after them if given."""
        end = [np.array([end_id], np.uint32)] if end_id is not None else []
        if not self.cuts:
            return [np.concatenate([ids, *end]) for ids in self._whole(texts)]
        odd = {k: np.concatenate([*self._specials(t), *end]) for k, t in enumerate(texts) if self.parts and self.parts.search(t)}
        rest = iter(self._plain([t for k, t in enumerate(texts) if k not in odd], end_id))
        return [odd[k] if k in odd else next(rest) for k in range(len(texts))]

    def _plain(self, texts: list[str], end_id: int | None) -> list[np.ndarray]:
        if len(self.count) > self.max_units:
            self._forget()
        numbers = [self._numbers(t) for t in texts]
        self._learn()
        if numbers:
            self.used += np.bincount(np.concatenate(numbers), minlength=len(self.used))
        out = []
        for n in numbers:
            count = self.count[n]
            total = int(count.sum())
            at = np.repeat(self.start[n] - (np.cumsum(count) - count), count)
            at += np.arange(total)
            ids = np.empty(total + (end_id is not None), np.uint32)
            ids[:total] = self.flat[at]
            if end_id is not None:
                ids[total] = end_id
            out.append(ids)
        return out


def encoder(path: str, specials_as_text: bool = False) -> Encoder:
    """This worker's encoder."""
    return keep(("encoder", path, specials_as_text), lambda: Encoder(path, specials_as_text=specials_as_text))


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def text_parts(batch: pa.RecordBatch, column: int = 1, most: int = 2_000_000) -> Iterator[tuple[int, pa.RecordBatch, list[str | None]]]:
    """(first row, rows, their texts): runs of a batch of about ``most`` bytes of text, one row at least, so that no whole batch is in Python."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    first = 0
    while first < batch.num_rows:
        before = int(ends[first - 1]) if first else 0
        end = max(first + 1, int(np.searchsorted(ends, before + most, side="right")))
        part = batch.slice(first, end - first)
        yield first, part, part.column(column).to_pylist()
        first = end
    pa.default_memory_pool().release_unused()
