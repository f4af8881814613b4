"""Token ids of whole texts by a public tokenizer file."""

from __future__ import annotations

import os
import re
from functools import lru_cache

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark runs a task on each core already

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer

VOCABULARY = "byte_bpe_50k.json"
KEPT_WORDS, KEPT_LENGTH = 400_000, 64
CALL_WORDS, GATHERED = 2_000, 1 << 18
# A single space between two other characters always starts a new piece in this vocabulary's own splitting rule.
WORD_START = re.compile(r"(?<=\S) (?=\S)")


def vocabulary_path(name: str = VOCABULARY) -> str:
    return public_tokenizers.path(name)


def uneven(word: str) -> bool:
    """Empty, or with white space at its ends: its text has runs of white space."""
    return not word or word.strip() != word


class _Words:
    """Ids of words as bytes. Unknown words are encoded many in a call; those of the last KEPT_WORDS to 2 KEPT_WORDS misses are kept."""

    def __init__(self, tokenizer: Tokenizer, before: str):
        self.tokenizer, self.before, self.kept, self.old = tokenizer, before, {}, {}
        # Ids whose token begins with a space, which the byte-level alphabet writes as this letter.
        size = 1 + max(tokenizer.get_vocab().values())
        self.opens = np.array([(tokenizer.id_to_token(i) or "").startswith("\u0120") for i in range(size)])

    def _encoded(self, words: list[str], single: bool) -> list[bytes]:
        """Ids of each word. Words that hold no space are encoded as one text and told apart by the tokens that begin with one."""
        if single and self.before:
            code = self.tokenizer.encode_batch_fast([self.before + self.before.join(words)], add_special_tokens=False)[0]
            ids = np.array(code.ids, "<u4")
            starts = np.flatnonzero(self.opens[ids])
            if len(starts) == len(words):
                data, at = ids.tobytes(), [*(4 * starts).tolist(), 4 * len(ids)]
                return [data[a:b] for a, b in zip(at, at[1:])]
        codes = self.tokenizer.encode_batch_fast([self.before + w for w in words], add_special_tokens=False)
        return [np.array(code.ids, "<u4").tobytes() for code in codes]

    def ids(self, words: list[str], even: bool) -> list[bytes | None]:
        """Ids of each of some distinct words; with `even`, none for words with white space at their ends."""
        if len(self.kept) >= KEPT_WORDS:
            self.old, self.kept = self.kept, {}
        kept, old = self.kept, self.old
        found = list(map(kept.get, words))
        unknown = []
        for i in [i for i, ids in enumerate(found) if ids is None]:
            word = words[i]
            if word in old:
                found[i] = kept[word] = old[word]
            elif not even or not uneven(word):
                unknown.append(i)
        for low in range(0, len(unknown), CALL_WORDS):
            part = unknown[low : low + CALL_WORDS]
            for i, ids in zip(part, self._encoded([words[i] for i in part], even)):
                found[i] = ids
                if len(words[i]) <= KEPT_LENGTH and (even or not uneven(words[i])):
                    kept[words[i]] = ids
        return found


def _gathered(parts: list[bytes], chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(ids of the chosen parts in a row, number of ids of each)."""
    size = np.fromiter(map(len, parts), np.int64, len(parts)) // 4
    first, data = np.cumsum(size) - size, np.frombuffer(b"".join(parts), "<u4")
    count = size[chosen]
    out, done = np.empty(count.sum(), "<u4"), 0
    for low in range(0, len(chosen), GATHERED):
        own = count[low : low + GATHERED]
        at = np.repeat(first[chosen[low : low + GATHERED]] - (np.cumsum(own) - own), own)
        at += np.arange(len(at))
        out[done : done + len(at)] = data[at]
        done += len(at)
    return out, count


class Encoder:
    """Ids by the tokenizers library, which sees each distinct word once as long as it is kept.

    The byte-level vocabularies split a text before every single space that stands between characters
    other than white space, and no merge crosses a split. So the ids of a text are the ids of its words (each with
    the space before it) in a row. Texts with runs of white space are cut at their single spaces only.
    """

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        self.first, self.later = _Words(self.tokenizer, ""), _Words(self.tokenizer, " ")

    def encode_all(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in a row, where each text begins and the last ends) of a text column; null counts as empty.

        The texts are split and their distinct words found in Arrow; Python sees each distinct word of the column once.
        """
        lists = pc.split_pattern(column.cast(pa.large_string()).fill_null(""), " ")
        begins = lists.offsets.to_numpy().astype(np.int64)[:-1]
        if not len(begins):
            return np.zeros(0, "<u4"), np.zeros(1, np.int64)
        coded = lists.values.dictionary_encode()
        chosen, words = coded.indices.to_numpy().astype(np.int64), coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        parts = self.later.ids(words, True)
        odd = np.logical_or.reduceat(np.fromiter((p is None for p in parts), bool, len(parts))[chosen], begins)
        # Behind the words after a space come the words that begin a text and the texts with runs of white space.
        heads, head = np.unique(chosen[begins[~odd]], return_inverse=True)
        rows = np.flatnonzero(odd)
        chosen[begins[~odd]] = len(parts) + head
        chosen[begins[odd]] = len(parts) + len(heads) + np.arange(len(rows))
        parts = [*parts, *self.first.ids([words[i] for i in heads], True), *(self.encode(column[i].as_py()) for i in rows.tolist())]
        use = np.repeat(~odd, np.diff(np.append(begins, len(chosen))))
        use[begins] = True
        ids, count = _gathered([p or b"" for p in parts], chosen[use])
        size = np.add.reduceat(count, (np.cumsum(use) - 1)[begins])
        return ids, np.concatenate([[0], np.cumsum(size)])

    def encode(self, text: str | None) -> bytes:
        """Ids as little-endian unsigned 32-bit integers; null counts as empty."""
        if not text:
            return b""
        first, *later = WORD_START.split(text)
        distinct = list(set(later))
        known = dict(zip(distinct, self.later.ids(distinct, False)))
        return b"".join([*self.first.ids([first], False), *map(known.__getitem__, later)])


@lru_cache(maxsize=1)
def encoder(path: str) -> Encoder:
    """The encoder of this Python worker; its words serve all tasks that the worker runs."""
    return Encoder(path)
