"""BPE encoding and decoding with a byte-level vocabulary, by speculation and verification.

The vocabulary is a file of the ``tokenizers`` library; its path is a parameter, it is read by the driver and sent to
the executors. Texts are split at special tokens, then by the byte-level pattern. For each different word

1. greedy longest match proposes tokens;
2. every adjacent pair is tested for compatibility, all pairs of a batch at once: back from the pair itself to the bytes at
   its boundary, no merge across the boundary may come before the merge that used up one of its sides. Tokens whose
   adjacent pairs are all compatible are what merging in order of rank would have made;
3. words with a pair that fails are merged exactly, by rank, with a heap.

Words are remembered, up to a bounded number. Decoding joins the bytes of the tokens; invalid UTF-8 is replaced.

Cases: a NULL text counts as empty, and has no tokens; rows that repeat an identifier are encoded one by one; an empty
table gives an empty result; other columns are not read. Memory is bounded by
the vocabulary and the longest text.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import unicodedata
from itertools import chain
from pathlib import Path

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keysweep.functions.columns import column
from keysweep.llm.text import batch_of, map_pieces

try:
    from tokenizers.pre_tokenizers import ByteLevel
except ImportError:  # splitting then follows the Unicode version of Python
    ByteLevel = None

# Fixed value: how byte-level vocabularies split text before merging.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
MOST_WORDS = 250_000
# Longer words, in characters, are not remembered.
LONG_WORD = 64
# Words of more bytes are merged with a heap.
SHORT_WORD = 64
# Bits of the number of slots of a table of merges, and the odd factor that deals pairs to them.
SLOT_BITS = 18
SLOT_FACTOR = 0x9E3779B97F4A7C15
NEVER = np.int64(1 << 40)


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in vocabulary files: printable ones for themselves, others from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


def letters_unknown_to_library() -> list[int]:
    """Code points that ``regex`` takes for letters or numbers and the library does not, being of an older Unicode.

    Only what Python does not know as assigned is in question; each is asked of the library once, behind a letter.
    """
    is_letter, is_number = regex.compile(r"\p{L}").match, regex.compile(r"\p{N}").match
    unsure = [chr(c) for c in range(0x110000) if unicodedata.category(chr(c)) == "Cn"]
    unsure = [(c, "a" if is_letter(c) else "1") for c in unsure if is_letter(c) or is_number(c)]
    if ByteLevel is None:
        return [ord(c) for c, _ in unsure]
    split = ByteLevel(add_prefix_space=False, use_regex=True).pre_tokenize_str
    whole = {span for _, span in split("".join(f" {like}{c}" for c, like in unsure))}
    return [ord(c) for i, (c, _) in enumerate(unsure) if (3 * i, 3 * i + 3) not in whole]


def in_ranges(points: list[int]) -> str:
    """``points`` as the inside of a character class."""
    out, at = [], 0
    while at < len(points):
        end = at
        while end + 1 < len(points) and points[end + 1] == points[end] + 1:
            end += 1
        out.append(f"\\U{points[at]:08X}-\\U{points[end]:08X}")
        at = end + 1
    return "".join(out)


class PairTable:
    """The places of numbers in a list, looked up by a hash; the few that share a slot are found by binary search."""

    def __init__(self, keys: np.ndarray):
        slots = self.slots(keys)
        _, first = np.unique(slots, return_index=True)
        self.key, self.place = np.full(1 << SLOT_BITS, -1, np.int64), np.full(1 << SLOT_BITS, NEVER)
        self.key[slots[first]], self.place[slots[first]] = keys[first], first
        more = np.setdiff1d(np.arange(len(keys)), first)
        more = more[np.argsort(keys[more])]
        self.crowded = np.zeros(1 << SLOT_BITS, bool)
        self.crowded[slots[more]] = True
        self.more_keys, self.more_places = np.append(keys[more], NEVER), np.append(more, NEVER)

    def slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(SLOT_FACTOR)) >> np.uint64(64 - SLOT_BITS)).astype(np.int64)

    def places(self, keys: np.ndarray) -> np.ndarray:
        slots = self.slots(keys)
        known = self.key[slots] == keys
        out = np.where(known, self.place[slots], NEVER)
        rest = np.flatnonzero(~known & self.crowded[slots])
        if len(rest):
            at = np.searchsorted(self.more_keys, keys[rest])
            out[rest] = np.where(self.more_keys[at] == keys[rest], self.more_places[at], NEVER)
        return out


class Vocabulary:
    """Tokens as bytes, merges by rank, and special tokens."""

    def __init__(self, path: str):
        raw = Path(path).read_bytes()
        self.digest = hashlib.sha256(raw).hexdigest()
        spec = json.loads(raw)
        model = spec["model"]
        split = spec["pre_tokenizer"]
        if model["type"] != "BPE" or split["type"] != "ByteLevel" or split["add_prefix_space"] or spec["normalizer"]:
            raise ValueError("the vocabulary is not a plain byte-level one")
        letters = byte_letters()
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        known = {t: i for t, i in model["vocab"].items() if t not in self.special}
        self.newer = in_ranges(letters_unknown_to_library())
        size = max([*known.values(), *self.special.values()]) + 1
        self.bytes: list[bytes] = [b""] * size
        for token, i in known.items():
            self.bytes[i] = bytes(letters[c] for c in token)
        for token, i in self.special.items():
            self.bytes[i] = token.encode()
        self.single = np.array([known[c] for c, _ in sorted(letters.items(), key=lambda x: x[1])])
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        left, right = (np.array([known[m[k]] for m in merges], np.int64) for k in (0, 1))
        made = np.array([known[a + b] for a, b in merges], np.int64)
        self.size = size
        self.single_list, self.made = self.single.tolist(), made
        self.pairs = PairTable(left * size + right)
        self.merges = {(int(a), int(b)): (r, int(c)) for r, (a, b, c) in reversed(list(enumerate(zip(left, right, made))))}
        # The merge that makes each token, and its sides; bytes are made by none.
        self.rank = np.full(size, -1, np.int64)
        self.left, self.right = np.arange(size), np.arange(size)
        for r in range(len(merges) - 1, -1, -1):
            self.rank[made[r]], self.left[made[r]], self.right[made[r]] = r, left[r], right[r]
        # A token that merging its own bytes does not make must not be proposed.
        whole = np.flatnonzero(self.rank >= 0)
        reached = np.ones(size, bool)
        reached[whole] = self.compatible(self.left[whole], self.right[whole], self.rank[whole])
        for i in whole[np.argsort(self.rank[whole])]:
            reached[i] &= reached[self.left[i]] and reached[self.right[i]]
        self.proposable = {b: i for i, b in enumerate(self.bytes) if b and reached[i] and b.decode("latin-1") not in self.special}
        self.longest = max(map(len, self.proposable))

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of the merge of each pair, ``NEVER`` if there is none."""
        return self.pairs.places(left * self.size + right)

    def compatible(self, left: np.ndarray, right: np.ndarray, own: np.ndarray | None = None) -> np.ndarray:
        """Whether nothing merges across the boundary of each pair (but the pair itself, if ``own`` is its rank)."""
        good = np.ones(len(left), bool)
        pair, x, y = np.arange(len(left)), np.asarray(left), np.asarray(right)
        used_x = np.full(len(x), NEVER) if own is None else np.asarray(own)
        used_y = np.full(len(x), NEVER) if own is None else np.asarray(own) - 1
        while len(pair):
            merge = self.ranks(x, y)
            # Of equal merges the one further left comes first: that within the left token, or else that across.
            across = (merge < used_x) & (merge <= used_y)
            good[pair[across]] = False
            rank_x, rank_y = self.rank[x], self.rank[y]
            go = ~across & ((rank_x >= 0) | (rank_y >= 0))
            pair, x, y, used_x, used_y, rank_x, rank_y = (v[go] for v in (pair, x, y, used_x, used_y, rank_x, rank_y))
            undo_x = rank_x > rank_y
            used_x, used_y = np.where(undo_x, rank_x, used_x), np.where(undo_x, used_y, rank_y)
            x, y = np.where(undo_x, self.right[x], x), np.where(undo_x, y, self.left[y])
        return good

    def proposed(self, word: bytes) -> list[int]:
        """Greedy longest match."""
        known, at, size, out = self.proposable, 0, len(word), []
        while at < size:
            end = min(size, at + self.longest)
            while word[at:end] not in known:
                end -= 1
            out.append(known[word[at:end]])
            at = end
        return out

    def merged(self, words: list[bytes]) -> list[list[int]]:
        """Exact merging by rank, the leftmost of equal ones first; of all words at once, one merge of each at a time."""
        out: list[list[int]] = [[]] * len(words)
        for i, w in enumerate(words):
            if len(w) > SHORT_WORD:
                out[i] = self.merged_long([self.single_list[b] for b in w])
        short = np.array([i for i, w in enumerate(words) if len(w) <= SHORT_WORD], np.int64)
        count = np.array([len(words[i]) for i in short], np.int64)
        tokens = self.single[np.frombuffer(b"".join([words[i] for i in short]), np.uint8)]
        rank = np.append(self.ranks(tokens[:-1], tokens[1:]), NEVER)
        rank[np.cumsum(count) - 1] = NEVER
        while len(short):
            starts = np.cumsum(count) - count
            least = np.minimum.reduceat(rank, starts)
            done = least == NEVER
            if done.any():
                for k in np.flatnonzero(done).tolist():
                    out[short[k]] = tokens[starts[k] : starts[k] + count[k]].tolist()
                stay = np.repeat(~done, count)
                tokens, rank, short, count, least = tokens[stay], rank[stay], short[~done], count[~done], least[~done]
                if not len(short):
                    break
                starts = np.cumsum(count) - count
            word = np.repeat(np.arange(len(short)), count)
            at = np.flatnonzero(rank == least[word])
            at = at[np.append(True, word[at[1:]] != word[at[:-1]])]
            tokens[at] = self.made[least]
            # The pair that began with the right side now begins with the new token; those on both sides are new.
            stay = np.ones(len(tokens), bool)
            stay[at + 1] = False
            is_last = at + 2 >= starts + count
            tokens, rank, count = tokens[stay], rank[stay], count - 1
            at = at - np.arange(len(at))
            follows = at[~is_last]
            rank[at[is_last]] = NEVER
            rank[follows] = self.ranks(tokens[follows], tokens[follows + 1])
            after = at[at > np.cumsum(count) - count]
            rank[after - 1] = self.ranks(tokens[after - 1], tokens[after])
        return out

    def merged_long(self, tokens: list[int]) -> list[int]:
        """The same with a heap."""
        before, after = list(range(-1, len(tokens) - 1)), list(range(1, len(tokens) + 1))
        heap = [(m[0], i, a, b) for i, (a, b) in enumerate(zip(tokens, tokens[1:])) if (m := self.merges.get((a, b)))]
        heapq.heapify(heap)
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = after[i]
            if tokens[i] != a or j >= len(tokens) or tokens[j] != b:
                continue
            tokens[i], tokens[j] = self.merges[a, b][1], -1
            after[i] = k = after[j]
            if k < len(tokens):
                before[k] = i
            for p, q in ((before[i], i), (i, k)):
                if p >= 0 and q < len(tokens) and (m := self.merges.get((tokens[p], tokens[q]))):
                    heapq.heappush(heap, (m[0], p, tokens[p], tokens[q]))
        return [t for t in tokens if t >= 0]

    def encode_words(self, words: list[bytes]) -> tuple[list[list[int]], int]:
        """Tokens of each word, and how many words the speculation got wrong."""
        found = [self.proposed(w) for w in words]
        count = np.fromiter(map(len, found), np.int64, len(found))
        tokens = np.fromiter(chain.from_iterable(found), np.int64, int(count.sum()))
        word = np.repeat(np.arange(len(found)), count)
        inner = np.flatnonzero(word[1:] == word[:-1])
        failed = np.unique(word[inner[~self.compatible(tokens[inner], tokens[inner + 1])]])
        for i, exact in zip(failed.tolist(), self.merged([words[i] for i in failed.tolist()])):
            found[i] = exact
        return found, len(failed)

    def decode(self, tokens: list[int]) -> str:
        return b"".join(map(self.bytes.__getitem__, tokens)).decode("utf-8", "replace")


class Encoder:
    """Encodes texts with the words it remembers."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.plain = regex.compile(PATTERN).findall
        newer = vocabulary.newer
        # Most texts hold nothing as high as the first of these code points, which is quick to see.
        self.is_high = re.compile(f"[{newer[:10]}-\\U0010FFFF]").search if newer else lambda text: None
        self.has_newer = regex.compile(f"[{newer}]").search if newer else lambda text: None
        # The same pattern with these code points as marks.
        older = PATTERN.replace(r"\p{L}+", rf"[\p{{L}}--[{newer}]]+").replace(r"\p{N}+", rf"[\p{{N}}--[{newer}]]+")
        older = older.replace(r"[^\s\p{L}\p{N}]+", rf"(?:[^\s\p{{L}}\p{{N}}]|[{newer}])+")
        self.older = regex.compile(older, regex.VERSION1).findall if newer else self.plain
        special = sorted(vocabulary.special, key=len, reverse=True)
        self.cut = re.compile("(" + "|".join(map(re.escape, special)) + ")").split if special else lambda text: [text]
        # Tokens as the bytes of 32-bit numbers.
        self.words: dict[str, bytes] = {}

    def split(self, text: str) -> list[str]:
        newer = not text.isascii() and self.is_high(text) and self.has_newer(text)
        return self.older(text) if newer else self.plain(text)

    def __call__(self, texts: list[str]) -> list[np.ndarray]:
        parts = [[[x] if k % 2 else self.split(x) for k, x in enumerate(self.cut(t))] for t in texts]
        seen = set().union(*[plain for text in parts for plain in text[::2]])
        new = seen - self.words.keys()
        if len(self.words) + len(new) > MOST_WORDS:
            self.words, new = {}, seen
        listed = list(new)
        found, _ = self.vocabulary.encode_words([w.encode() for w in listed])
        self.words.update(zip(listed, [np.array(t, np.int32).tobytes() for t in found]))
        known, special = self.words, self.vocabulary.special
        out = []
        for text in parts:
            packed = [np.int32(special[x[0]]).tobytes() if k % 2 else b"".join([known[w] for w in x]) for k, x in enumerate(text)]
            out.append(np.frombuffer(b"".join(packed), np.int32))
        for w in listed:
            if len(w) > LONG_WORD:
                del self.words[w]
        return out


# Encoders of this worker process by vocabulary; the words they remember outlast a task.
_encoders: dict[str, Encoder] = {}


def encoder_of(name: str, shared) -> Encoder:
    if name not in _encoders:
        _encoders.clear()
        _encoders[name] = Encoder(shared.value)
    return _encoders[name]


def bpe(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: doc_id, ids (token numbers) and decoded (the text of these tokens)."""
    rows = docs.select(column(id_col).cast("bigint").alias("id"), column(text_col).alias("text"))
    vocabulary = Vocabulary(path)
    shared, name = docs.sparkSession.sparkContext.broadcast(vocabulary), vocabulary.digest

    def encode(piece: pa.RecordBatch) -> pa.RecordBatch:
        encoder = encoder_of(name, shared)
        tokens = encoder([t or "" for t in piece.column("text").to_pylist()])
        sizes = np.concatenate([[0], np.cumsum(np.fromiter(map(len, tokens), np.int64, len(tokens)))])
        return batch_of(
            doc_id=piece.column("id"),
            ids=pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), pa.array(np.concatenate(tokens))),
            decoded=[encoder.vocabulary.decode(t.tolist()) for t in tokens],
        )

    return map_pieces(rows, ["id", "text"], encode, "doc_id long, ids array<int>, decoded string")


def bpe_digest(encoded: DataFrame, *more: str) -> DataFrame:
    """Number of tokens, and checksums of their numbers and of the decoded text; columns ``more`` of ``encoded`` follow."""
    numbers = F.array_join(F.col("ids").cast("array<string>"), ",")
    return encoded.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(numbers, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        *more,
    )
