"""Byte-level BPE with a memory-mapped minimal automaton of frequent words."""

from __future__ import annotations

import hashlib
import heapq
import json
import mmap
import re
import struct
import sys
import uuid
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import frugal, materialise, map_ids, write_shared
from .wordids import BYTE_LETTERS

# Unicode white space, and the public pattern that splits text before merges (white space spelt out).
SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
PATTERN = rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{SPACE}\p{{L}}\p{{N}}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"

#: Cuts only where a run of ASCII white space begins; no word of PATTERN crosses such a place.
_PIECES = re.compile(r"[ \t-\r]*[^ \t-\r]+|[ \t-\r]+")
#: Texts with other white space are split as a whole.
_OTHER_SPACE = re.compile("[\x85\xa0  -     　]")
REMEMBERED = 600_000
COUNTED = 400_000
LEXICON_WORDS = 65_536
LONG = 64
#: Ids take so many bits of a merge's number.
ID_BITS = 24
ID_MASK = (1 << ID_BITS) - 1
NONE = 1 << 60
_MAGIC = b"MATL"


class Vocabulary:
    """Tokens and merge ranks of a tokenizer file, in byte-letters."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.ids: dict[str, int] = spec["model"]["vocab"]
        merges = spec["model"]["merges"]
        pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in merges]
        #: pair of ids, as one number -> rank and the id it becomes, as one number; the least has the lowest rank
        self.merges = {self.ids[a] << ID_BITS | self.ids[b]: rank << ID_BITS | self.ids[a + b] for rank, (a, b) in reversed([*enumerate(pairs)])}
        self.letter = [self.ids[BYTE_LETTERS[b]] for b in range(256)]
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        back = {c: b for b, c in BYTE_LETTERS.items()}
        size = max([*self.ids.values(), *self.special.values()]) + 1
        self.bytes_of: list[bytes] = [b""] * size
        for t, i in self.ids.items():
            self.bytes_of[i] = bytes(back[c] for c in t) if all(c in back for c in t) else t.encode()
        for t, i in self.special.items():
            self.bytes_of[i] = t.encode()
        self.split = regex.compile(PATTERN)
        self.special_split = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")") if self.special else None

    def merge(self, word: bytes) -> list[int]:
        """Ids of one pre-split word: the leftmost pair of lowest rank is merged until none is left."""
        parts = [*map(self.letter.__getitem__, word)]
        if len(parts) > LONG:
            return self._merge_long(parts)
        get = self.merges.get
        found = [get(a << ID_BITS | b, NONE) for a, b in zip(parts, parts[1:])]
        while found:
            best = min(found)
            if best == NONE:
                break
            i = found.index(best)
            new = parts[i] = best & ID_MASK
            del parts[i + 1], found[i]
            if i:
                found[i - 1] = get(parts[i - 1] << ID_BITS | new, NONE)
            if i < len(found):
                found[i] = get(new << ID_BITS | parts[i + 1], NONE)
        return parts

    def _merge_long(self, parts: list[int]) -> list[int]:
        """The same with a heap over linked parts, for words of any length."""
        get, n = self.merges.get, len(parts)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i, parts[i], parts[i + 1]) for i in range(n - 1) if (r := get(parts[i] << ID_BITS | parts[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            best, i, left, right = heapq.heappop(heap)
            j = after[i]
            if parts[i] != left or j >= n or parts[j] != right:
                continue
            parts[i] = best & ID_MASK
            parts[j] = -1
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            for k in (before[i], i):
                if k >= 0 and after[k] < n and (r := get(parts[k] << ID_BITS | parts[after[k]])) is not None:
                    heapq.heappush(heap, (r, k, parts[k], parts[after[k]]))
        return [p for p in parts if p >= 0]


_VOCABULARIES: dict[str, Vocabulary] = {}


def vocabulary(path: str) -> Vocabulary:
    """A worker reads a tokenizer file once."""
    if path not in _VOCABULARIES:
        _VOCABULARIES[path] = Vocabulary(path)
    return _VOCABULARIES[path]


def build_automaton(entries: list[tuple[bytes, list[int]]]) -> bytes:
    """A minimal acyclic automaton of the words with their ids as output.

    Words are added in order and states with equal futures are shared as soon as
    they can no longer change (Daciuk et al., 2000). An arc stores how many
    words precede those through it, so a walk yields the word's number, which
    finds its ids. Layout: magic, counts, then flat little-endian arrays.
    """
    entries = sorted(entries)
    arcs: list[dict[int, int]] = [{}]
    final: list[bool] = [False]
    register: dict[tuple, int] = {}
    path: list[tuple[int, int, int]] = []

    def close(depth: int) -> None:
        while len(path) > depth:
            parent, label, child = path.pop()
            key = (final[child], *arcs[child].items())
            same = register.setdefault(key, child)
            arcs[parent][label] = same

    last = b""
    for word, _ in entries:
        shared = 0
        while shared < min(len(word), len(last)) and word[shared] == last[shared]:
            shared += 1
        close(shared)
        state = path[-1][2] if path else 0
        for b in word[shared:]:
            arcs.append({})
            final.append(False)
            arcs[state][b] = len(arcs) - 1
            path.append((state, b, len(arcs) - 1))
            state = len(arcs) - 1
        final[state] = True
        last = word
    close(0)

    number, order, stack = {0: 0}, [0], [0]
    while stack:
        for t in arcs[stack.pop()].values():
            if t not in number:
                number[t] = len(order)
                order.append(t)
                stack.append(t)
    words: dict[int, int] = {}
    stack = [0]
    while stack:
        s = stack[-1]
        todo = [t for t in arcs[s].values() if t not in words]
        if todo:
            stack.extend(todo)
        else:
            words[s] = final[s] + sum(words[t] for t in arcs[s].values())
            stack.pop()
    first, labels, targets, before = [0], bytearray(), [], []
    for s in order:
        n = int(final[s])
        for b, t in sorted(arcs[s].items()):
            labels.append(b)
            targets.append(number[t])
            before.append(n)
            n += words[t]
        first.append(len(labels))
    flat = [i for _, ids in entries for i in ids]
    ends = np.cumsum([0, *[len(ids) for _, ids in entries]])
    arrays = [np.array(first, "<u4"), np.array([final[s] for s in order], "<u1"), np.frombuffer(bytes(labels), "<u1"), np.array(targets, "<u4"), np.array(before, "<u4"), ends.astype("<u4"), np.array(flat, "<u4")]
    blobs = [a.tobytes() for a in arrays]
    return _MAGIC + struct.pack("<7I", *map(len, blobs)) + b"".join(blobs)


class Automaton:
    """The file of build_automaton, memory-mapped, so that workers on one machine share its pages."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            self.map = mmap.mmap(f.fileno(), 0, access=mmap.ACCESS_READ)
        if self.map[:4] != _MAGIC:
            raise ValueError(f"{path} is no automaton")
        sizes = struct.unpack("<7I", self.map[4:32])
        at = np.cumsum([32, *sizes])
        view = memoryview(self.map)
        # byte order as written: these machines are little-endian, others take a copy
        get = lambda i: view[at[i] : at[i + 1]].cast("I") if sys.byteorder == "little" else np.frombuffer(view[at[i] : at[i + 1]], "<u4").tolist()
        self.first, self.targets, self.before, self.ends = get(0), get(3), get(4), get(5)
        self.final, self.ids = view[at[1] : at[2]], view[at[6] : at[7]]
        self.labels_at = int(at[2])

    def get(self, word: bytes) -> bytes | None:
        """The word's ids as stored, or None where it is not in the lexicon."""
        state = index = 0
        find, base, first, before, targets = self.map.find, self.labels_at, self.first, self.before, self.targets
        for i in range(len(word)):
            arc = find(word[i : i + 1], base + first[state], base + first[state + 1])
            if arc < 0:
                return None
            arc -= base
            index += before[arc]
            state = targets[arc]
        return bytes(self.ids[4 * self.ends[index] : 4 * self.ends[index + 1]]) if self.final[state] else None


def is_word(piece: str) -> bool:
    """Letters, after a space or not: one word of PATTERN."""
    return piece.isalpha() or piece[0] == " " and piece[1:].isalpha()


class Encoder(dict):
    """piece of text -> ids as little-endian unsigned 32-bit integers."""

    def __init__(self, vocabulary: Vocabulary, automaton: Automaton | None):
        self.vocabulary, self.automaton = vocabulary, automaton
        self.old: dict[str, bytes] = {}

    def word(self, word: str) -> bytes:
        """Ids of one pre-split word: remembered, looked up, or merged."""
        made = self.get(word)
        if made is None and (made := self.old.get(word)) is not None:
            self.keep(word, made)
        if made is None:
            raw = word.encode()
            made = self.automaton.get(raw) if self.automaton else None
            if made is None:
                ids = self.vocabulary.merge(raw)
                made = struct.pack(f"<{len(ids)}I", *ids)
            self.keep(word, made)
        return made

    def keep(self, piece: str, made: bytes) -> None:
        """Remember in the young table; a full one becomes the old table, from which pieces return when met again."""
        if len(self) >= REMEMBERED:
            self.old = dict(self)
            self.clear()
        self[piece] = made

    def whole(self, text: str) -> bytes:
        return b"".join(map(self.word, self.vocabulary.split.findall(text)))

    def __missing__(self, piece: str) -> bytes:
        if is_word(piece):
            return self.word(piece)
        if (made := self.old.get(piece)) is not None:
            self.keep(piece, made)
            return made
        if piece[-1] in ",." and piece[:-1].lstrip(" ").isalpha() and piece[1:2] != " ":
            made = self.word(piece[:-1]) + self.word(piece[-1])
        else:
            made = self.whole(piece)
        self.keep(piece, made)
        return made

    def plain(self, text: str) -> bytes:
        if not text.isascii() and _OTHER_SPACE.search(text):
            return self.whole(text)
        return b"".join(map(self.__getitem__, _PIECES.findall(text)))

    def ids(self, text: str) -> bytes:
        v = self.vocabulary
        if not any(s in text for s in v.special):
            return self.plain(text)
        out = []
        for i, part in enumerate(v.special_split.split(text)):
            out.append(np.array([v.special[part]], "<u4").tobytes() if i % 2 else self.plain(part))
        return b"".join(out)

    def decode(self, ids: bytes) -> bytes:
        table = self.vocabulary.bytes_of
        return b"".join([table[i] for i in np.frombuffer(ids, "<u4").tolist()])


_ENCODERS: dict[tuple[str, str], Encoder] = {}


def _encoder(path: str, name: str) -> Encoder:
    if (path, name) not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[path, name] = Encoder(vocabulary(path), Automaton(SparkFiles.get(name)))
    return _ENCODERS[path, name]


def frequent_words(docs: DataFrame, tokenizer_path: str, size: int = LEXICON_WORDS) -> list[bytes]:
    """The `size` most frequent pre-split words of all documents (ties: by bytes). docs: (id, text)."""

    def count(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        v = vocabulary(tokenizer_path)
        pieces: Counter = Counter()

        def flush() -> pd.DataFrame:
            words: Counter = Counter()
            for p, n in pieces.items():
                if is_word(p):
                    words[p] += n
                else:
                    for w in v.split.findall(p):
                        words[w] += n
            pieces.clear()
            return pd.DataFrame({"word": [w.encode() for w in words], "n": list(words.values())})

        for pdf in parts:
            for t in pdf["text"]:
                for part in v.special_split.split(t)[::2] if any(s in t for s in v.special) else (t,):
                    if not part.isascii() and _OTHER_SPACE.search(part):
                        pieces.update(v.split.findall(part))
                    else:
                        pieces.update(_PIECES.findall(part))
                if len(pieces) > COUNTED:
                    yield flush()
        yield flush()

    counts = docs.mapInPandas(frugal(count), "word binary, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    counts = materialise(counts, "words", "zstd")
    # the least count whose words, and those of larger ones, are `size` at most; only chosen words come to the driver
    found, least = 0, None
    for r in counts.groupBy("n").agg(F.count("*").alias("c")).orderBy(F.desc("n")).limit(size).collect():
        found += r.c
        if found > size:
            break
        least = r.n
    if least is None:
        return []
    return [bytes(r.word) for r in counts.where(F.col("n") >= least).select("word").collect()]  # size rows at most


def bpe_round_trip(docs: DataFrame, tokenizer_path: str, lexicon_words: int = LEXICON_WORDS, with_ids: bool = False, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, n_tokens, ids_sha256, decoded_sha256[, ids]), one row per row of docs.

    The most frequent words of all documents are compiled with their ids into a
    minimal acyclic automaton, a file that Spark sends to each executor once
    and workers memory-map. Words in it are looked up; all others are merged exactly
    by rank. A worker remembers pieces it has met, in a table of bounded size.
    Special tokens in a text are ids of their own, as in the library.

    Null and empty texts have no tokens; null ids and repeated rows pass
    through; an empty table gives no rows; other columns are ignored.
    """
    spark = docs.sparkSession
    own = docs.select(F.col(id_col).cast("bigint").alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    v = vocabulary(tokenizer_path)
    lexicon = build_automaton([(w, v.merge(w)) for w in frequent_words(own, tokenizer_path, lexicon_words)])
    name = f"lexicon-{uuid.uuid4().hex}.bin"
    spark.sparkContext.addFile(write_shared(spark, name, lexicon))  # each executor fetches one copy

    def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        e = _encoder(tokenizer_path, name)
        for pdf in parts:
            n, ids_sha, text_sha, kept = [], [], [], []
            for t in pdf["text"]:
                ids = e.ids(t)
                n.append(len(ids) // 4)
                ids_sha.append(hashlib.sha256(ids).hexdigest())
                text_sha.append(hashlib.sha256(e.decode(ids).decode("utf-8", "replace").encode()).hexdigest())
                if with_ids:
                    kept.append(ids)
            yield pd.DataFrame({"id": pdf["id"], "n_tokens": n, "ids_sha256": ids_sha, "decoded_sha256": text_sha} | ({"ids": kept} if with_ids else {}))

    out = map_ids(own, run, "id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string" + ", ids binary" * with_ids)
    return out.withColumnRenamed("id", id_col)
