"""A hidden Markov language model, trained by Baum-Welch over all documents.

Each word has its own emission probability in each state. With p(w) its add-one
unigram probability, e(w, s) its expected counts in the states, c(w) their sum and
q(s) the states' shares of all counts in the round before,

    u(w, s) = (e(w, s) + SMOOTH q(s)) / (c(w) + SMOOTH),
    P(w | s) / p(w) = (1 - FLOOR) u(w, s) / Z(s) + FLOOR,

where Z(s) = sum of p(w) u(w, s) over all known words and one unknown word (which has
u = q), so that P(. | s) sums to 1 over them. Hence

    log P(text) = base_score + log sum over paths of prod P(s'|s) P(w|s') / p(w).

Documents are read once, into chunks that number their own words. The vocabulary is
dealt out by hash over slices; a chunk keeps its words in the order of the slices, and
for each slice there is one row with the chunk's words in it. A round sends u from the
slices to the chunks (two bytes a word and state) and expected counts back, so neither
the vocabulary nor its counts are ever gathered in one place, and a very frequent word
is one entry of its slice. u is used as it was rounded, in Z too.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, frugal, give_back, materialise, unveiled, veiled
from .labelled import fold_of

STATES = 8
ROUNDS = 3
#: The starting point: hash buckets of words, rounds, and words on end that are taken to share a state.
BUCKETS = 1 << 12
START_ROUNDS = 8
STRETCH = 16
SMOOTH = 5.0
FLOOR = 0.02
END = b" "
CHUNK_BYTES = 32 << 20
BATCH_TOKENS = 400_000
#: Groups in which the chunks' sums of moves are added before they are added up.
GROUPS = 64


def _e_step(seqs: list[np.ndarray], model: dict, counts: dict | None, batch: int = BATCH_TOKENS) -> np.ndarray:
    """Natural-log path sums of sequences of row numbers of model["ratio"] (each of length >= 1); adds expected counts to `counts`.

    Sequences are run side by side, sorted by length, with scaled forward recursions
    over whole sequences. For counts a backward recursion follows, block by block from
    the end: a sequence longer than `batch` keeps the forward values at the blocks'
    beginnings only and computes those inside a block again.
    """
    a, start, ratio = (np.ascontiguousarray(model[x], np.float32) for x in ("a", "start", "ratio"))
    k, back = len(start), np.ascontiguousarray(a.T)
    one = np.ones(k, np.float32)
    order = np.argsort([-len(s) for s in seqs], kind="stable")
    out = np.zeros(len(seqs))
    at = 0
    while at < len(order):
        longest = len(seqs[order[at]])
        n = max(1, min(len(order) - at, batch // longest))
        own = order[at : at + n]
        at += n
        lens = np.array([len(seqs[i]) for i in own])
        b = np.zeros((longest, n), np.int32)
        for j, i in enumerate(own):
            b[: lens[j], j] = seqs[i]
        live = (lens[None, :] > np.arange(longest)[:, None]).sum(axis=1)
        total = np.zeros(n)

        def forward(t0: int, t1: int, now: np.ndarray, keep: bool, add: bool):
            """The values at the end of the block, and if kept all of them, their sums and the words' ratios."""
            alpha = np.empty((t1 - t0, n, k), np.float32) if keep else None
            scale, seen = np.ones((t1 - t0, n), np.float32), ratio.take(b[t0:t1], axis=0)
            for t in range(t0, t1):
                m = live[t]
                now = (now[:m] @ a if t else now[:m]) * seen[t - t0, :m]
                c = np.matmul(now, one, out=scale[t - t0, :m])
                now /= c[:, None]
                if keep:
                    alpha[t - t0, :m] = now
            if add:
                total[:] += np.log(scale).sum(axis=0, dtype=np.float64)
            return now, alpha, scale, seen

        step = max(1, batch // n)
        blocks = [(t, min(longest, t + step)) for t in range(0, longest, step)]
        heads = [np.broadcast_to(start, (n, k))]
        kept, moves = None, np.zeros((k, k))
        for t0, t1 in blocks:
            now, *kept = forward(t0, t1, heads[-1], counts is not None and len(blocks) == 1, True)
            heads.append(now)
        out[own] = total
        if counts is None:
            continue
        beta, after, then = np.ones((n, k), np.float32), None, None
        for (t0, t1), head in zip(reversed(blocks), reversed(heads[:-1])):
            alpha, scale, seen = kept if len(blocks) == 1 else forward(t0, t1, head, True, False)[1:]
            for t in range(t1 - 1, t0 - 1, -1):
                m = live[t]
                if t + 1 < longest:
                    m2 = live[t + 1]
                    ahead = then[:m2] * beta[:m2]
                    ahead /= after[:m2, None]
                    moves += alpha[t - t0, :m2].T @ ahead
                    np.matmul(ahead, back, out=beta[:m2])
                after, then = scale[t - t0], seen[t - t0]
                g = alpha[t - t0, :m]
                g *= beta[:m]
                g /= (g @ one)[:, None]
            if not t0:
                counts["start"] += alpha[0, : live[0]].sum(axis=0, dtype=np.float64)
                counts["a"] += a * moves
            flat = np.concatenate([b[t, : live[t]] for t in range(t0, t1)])
            post = np.concatenate([alpha[t - t0, : live[t]] for t in range(t0, t1)])
            for s in range(k):
                counts["emit"][:, s] += np.bincount(flat, post[:, s], minlength=len(ratio))
    return out


def _stretch_step(tokens: np.ndarray, lens: np.ndarray, model: dict, counts: dict, batch: int = BATCH_TOKENS) -> None:
    """Adds to `counts` what is expected of texts (laid end to end, all of length >= 1) that may change their state at every STRETCH words only."""
    each = -(-lens // STRETCH)
    nth = np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)
    at = np.append(np.repeat(np.cumsum(lens) - lens, each) + STRETCH * nth, len(tokens))
    log, prior, last = np.log(model["ratio"]).astype(np.float32), np.log(model["share"]), None
    step = max(1, batch // STRETCH)
    for i in range(0, len(nth), step):
        own = at[i : i + step + 1]
        x, size, goes_on = tokens[own[0] : own[-1]], np.diff(own), nth[i : i + step] > 0
        post = np.add.reduceat(log[x], own[:-1] - own[0], axis=0) + prior
        post = np.exp(post - post.max(axis=1, keepdims=True))
        post /= post.sum(axis=1, keepdims=True)
        for s in range(len(prior)):
            counts["emit"][:, s] += np.bincount(x, np.repeat(post[:, s], size), minlength=len(log))
        counts["start"] += post[~goes_on].sum(axis=0)
        before = np.concatenate([post[:1] if last is None else last, post[:-1]])
        counts["a"] += before[goes_on].T @ post[goes_on] + np.diag((size - 1) @ post)
        last = post[-1:]


def _model(start: np.ndarray, a: np.ndarray, emit: np.ndarray, base: np.ndarray) -> dict:
    """The start model's probabilities from expected counts of buckets; base: the buckets' own shares."""
    k = len(start)
    start, a = _moves(start, a)
    share = (emit.sum(axis=0) + 1.0) / (emit.sum() + k)
    given = base[:, None] * (emit + SMOOTH * share) / ((emit.sum(axis=1, keepdims=True) + SMOOTH) * share)
    given = (1 - FLOOR) * given / given.sum(axis=0) + FLOOR * base[:, None]
    return {"start": start, "a": a, "ratio": given / base[:, None], "share": share}


def _moves(start: np.ndarray, a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First states and moves from expected counts, smoothed evenly."""
    a = a + 1.0 / len(start)
    return (start + 1.0) / (start + 1.0).sum(), a / a.sum(axis=1, keepdims=True)


def _first(base: np.ndarray, states: int) -> dict:
    rng = np.random.RandomState(11)
    given = base[:, None] * rng.uniform(0.5, 1.5, (len(base), states))
    given /= given.sum(axis=0)
    a = np.full((states, states), 0.2 / states) + 0.8 * np.eye(states)
    return {"start": np.full(states, 1 / states), "a": a, "ratio": given / base[:, None], "share": np.full(states, 1 / states)}


def _zero(states: int, size: int = BUCKETS + 1) -> dict:
    return {"a": np.zeros((states, states)), "start": np.zeros(states), "emit": np.zeros((size, states))}


def _hash(word: bytes) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(word, 42)


def _bucket(word: bytes) -> int:
    return BUCKETS if word == END else _hash(word) % BUCKETS


def _words(text: str) -> list[bytes]:
    return [*text.encode().lower().split(), END]


def _squeeze(x: np.ndarray) -> bytes:
    """An array of whole numbers, its bytes grouped by place, compressed."""
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(np.ascontiguousarray(x).view(np.uint8).reshape(len(x), -1).T).tobytes())


def _unsqueeze(blob: bytes, kind: str) -> np.ndarray:
    raw, size = np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), np.uint8), np.dtype(kind).itemsize
    return np.ascontiguousarray(raw.reshape(size, -1).T).view(kind).ravel()


def _pack_words(words: list[bytes]) -> bytes:
    return zstandard.ZstdCompressor(level=3).compress(b"\n".join(words))


def _unpack_words(blob: bytes) -> list[bytes]:
    return zstandard.ZstdDecompressor().decompress(blob).split(b"\n")


class _Chunk:
    """Documents whose words are numbered in the order of their slices."""

    def __init__(self, slices: int, held: int):
        self.slices, self.held = slices, held
        self.begin()

    def begin(self):
        class Numbers(dict):
            def __missing__(self, w):
                n = self[w] = len(self)
                return n

        self.lids, self.docs, self.size = Numbers(), [], 0

    def add(self, doc_id, fold: int, text: str) -> None:
        words = _words(text)
        self.docs.append((doc_id, fold, np.fromiter(map(self.lids.__getitem__, words), np.int32, len(words))))
        self.size += len(text)

    def close(self, chunk: int) -> list[tuple]:
        """(kind, chunk, slice, a, b, c, d) rows: kind 0 holds (tokens, ids with folds and lengths, buckets, slices with their numbers of words), kind 1 a slice's (words, training counts)."""
        words, n = list(self.lids), len(self.lids)
        hashes = np.fromiter(map(_hash, words), np.uint64, n)
        dest = (hashes // np.uint64(BUCKETS) % np.uint64(self.slices)).astype(np.int64)
        order = np.argsort(dest, kind="stable")
        place = np.empty(n, np.int32)
        place[order] = np.arange(n, dtype=np.int32)
        tf = np.zeros(n, np.int64)
        for _, f, x in self.docs:
            if f != self.held:
                if len(x) > 5000:
                    tf += np.bincount(x, minlength=n)
                else:
                    np.add.at(tf, x, 1)
        bucket = (hashes % np.uint64(BUCKETS)).astype(np.uint16)
        bucket[self.lids.get(END, 0)] = BUCKETS
        tokens = place[np.concatenate([d[2] for d in self.docs])]
        about = np.array([(i, f, len(x)) for i, f, x in self.docs], np.int64)
        parts = np.split(order, np.flatnonzero(np.diff(dest[order])) + 1)
        sizes = np.array([(dest[own[0]], len(own)) for own in parts], np.int64)
        rows = [(0, chunk, 0, _squeeze(tokens), _squeeze(about.ravel()), _squeeze(bucket[order]), _squeeze(sizes.ravel()))]
        rows += [(1, chunk, int(dest[own[0]]), _pack_words([words[i] for i in own]), _squeeze(tf[own]), None, None) for own in parts]
        self.begin()
        return rows


PIECES = "kind int, chunk bigint, slice int, a binary, b binary, c binary, d binary"
SENT = "slice int, chunk bigint, data binary"
LEARNT_COLUMNS = ["kind", "chunk", "slice", "u", "c", "sums"]
LEARNT = "kind int, chunk bigint, slice int, u binary, c binary, sums array<double>"


def _documents(a: bytes, b: bytes) -> tuple[list[np.ndarray], np.ndarray]:
    """(token arrays, rows of (id, fold, length)) of a chunk."""
    about = _unsqueeze(b, "<i8").reshape(-1, 3)
    return np.split(_unsqueeze(a, "<i4"), np.cumsum(about[:-1, 2])), about


def _ratios(u: np.ndarray, model: dict) -> np.ndarray:
    """P(w | s) / p(w) from u(w, s) as it was sent."""
    return (1 - FLOOR) * u.astype(np.float64) / model["z"] + FLOOR


@dataclass
class Trained:
    """What training leaves: chunks and their slices' words, the last profiles (u and counts by chunk and slice), and the model."""

    pieces: DataFrame
    profile: DataFrame
    model: dict
    n_train: int
    denominator: float


def train(docs: DataFrame, folds: int, held: int, states: int, rounds: int, id_col: str, text_col: str) -> Trained:
    """Read all documents and learn from those outside the held-out fold."""
    spark = docs.sparkSession
    own = docs.select(F.col(id_col).cast("bigint").alias("id"), fold_of(F.col(id_col).cast("bigint"), folds).alias("fold"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    size = own.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("bytes")).first()
    slices = max(8, 2 * -(-size.bytes // CHUNK_BYTES))

    def read(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        place, serial, chunk = TaskContext.get().partitionId(), 0, _Chunk(slices, held)

        def close() -> pd.DataFrame:
            return pd.DataFrame(chunk.close((place << 24) + serial), columns=["kind", "chunk", "slice", "a", "b", "c", "d"])

        for pdf in parts:
            for i, f, t in zip(pdf["id"], pdf["fold"], pdf["text"]):
                chunk.add(int(i), f, t)
                if chunk.size >= CHUNK_BYTES:
                    yield close()
                    serial += 1
        if chunk.docs:
            yield close()

    pieces = materialise(own.withColumn("id", veiled()).mapInPandas(frugal(read), PIECES), "lm-pieces", "uncompressed")
    chunks, asked = pieces.where("kind = 0").select("chunk", "a", "b", "c", "d"), pieces.where("kind = 1").select("slice", "chunk", "a", "b")

    def number(pdf: pd.DataFrame) -> pd.DataFrame:
        """A slice's words as numbers, by chunk; the slice's tokens and distinct words on its first row."""
        known: dict[bytes, int] = {}
        rows = []
        for blob in pdf["a"]:
            rows.append(np.fromiter((known.setdefault(w, len(known)) for w in _unpack_words(blob)), np.int32))
        c = np.zeros(len(known), np.int64)
        for g, b in zip(rows, pdf["b"]):
            c[g] += _unsqueeze(b, "<i8")
        n = [int(c.sum()), *[0] * (len(rows) - 1)]
        v = [int((c > 0).sum()), *[0] * (len(rows) - 1)]
        return pd.DataFrame({"slice": pdf["slice"], "chunk": pdf["chunk"], "gid": [_squeeze(g) for g in rows], "tf": pdf["b"], "n": n, "v": v})

    numbered = materialise(asked.groupBy("slice").applyInPandas(number, "slice int, chunk bigint, gid binary, tf binary, n bigint, v bigint"), "lm-numbered", "uncompressed")
    totals = numbered.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum("v"), F.lit(0)).alias("v")).first()
    n_train, denominator = int(totals.n), float(totals.n + totals.v + 1)
    even = np.full(states, 1 / states)
    model = {"start": even, "a": np.tile(even, (states, 1)), "share": even}

    def begin(model: dict):
        def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            c = _zero(states)
            for pdf in parts:
                for a, b, buckets in zip(pdf["a"], pdf["b"], pdf["c"]):
                    about = _unsqueeze(b, "<i8").reshape(-1, 3)
                    learnt = about[:, 1] != held
                    tokens = _unsqueeze(buckets, "<u2")[_unsqueeze(a, "<i4")][np.repeat(learnt, about[:, 2])]
                    _stretch_step(tokens, about[learnt, 2], model, c)
            yield pd.DataFrame({"part": [TaskContext.get().partitionId() % GROUPS], "sums": [np.concatenate([c["start"], c["a"].ravel(), c["emit"].ravel()]).tobytes()]})

        return frugal(run)

    def add_up(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"part": pdf["part"].iloc[:1], "sums": [sum(map(np.frombuffer, pdf["sums"])).tobytes()]})

    if n_train and rounds:
        now = _first(np.full(BUCKETS + 1, 1 / (BUCKETS + 1)), states)
        for _ in range(START_ROUNDS):
            sums = chunks.select("a", "b", "c").mapInPandas(begin(now), "part int, sums binary").groupBy("part").applyInPandas(add_up, "part int, sums binary")
            # GROUPS rows of a fixed size at most
            start, a, emit = np.split(sum(np.frombuffer(r.sums) for r in sums.collect()), [states, states + states * states])
            emit = emit.reshape(-1, states)
            base = emit.sum(axis=1) + 1.0
            now = _model(start, a.reshape(states, states), emit, base / base.sum())
        model = {"start": now["start"], "a": now["a"], "share": now["share"], "buckets": now["ratio"].astype(np.float32)}

    def expected(model: dict, a: bytes, b: bytes, chunk: int, ratio: np.ndarray, sizes: list[tuple[int, int]]) -> list[tuple]:
        """(slice, chunk, blob) rows: for each slice its words' shares of the states in 16 bits, and the chunk's sums of moves under a negative slice."""
        seqs, about = _documents(a, b)
        learn = [s for s, f in zip(seqs, about[:, 1]) if f != held]
        c = _zero(states, len(ratio))
        if learn:
            _e_step(learn, {"a": model["a"], "start": model["start"], "ratio": ratio}, c)
        emit = c["emit"]
        sums = np.concatenate([c["start"], c["a"].ravel(), emit.sum(axis=0)])
        share = np.rint(65535 * emit / np.maximum(emit.sum(axis=1, keepdims=True), 1e-30)).astype("<u2")
        rows, at = [(-1 - chunk % GROUPS, chunk, sums.tobytes())], 0
        for s, n in sizes:
            rows.append((s, chunk, share[at : at + n].tobytes()))
            at += n
        return rows

    def first_round(model: dict):
        def run(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in parts:
                for chunk, a, b, c, d in zip(pdf["chunk"], pdf["a"], pdf["b"], pdf["c"], pdf["d"]):
                    ratio = model["buckets"][_unsqueeze(c, "<u2")]
                    yield pd.DataFrame(expected(model, a, b, chunk, ratio, _unsqueeze(d, "<i8").reshape(-1, 2).tolist()), columns=["slice", "chunk", "data"])

        return frugal(run)

    def next_round(model: dict):
        def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
            rows = []
            for chunk, a, b in zip(left["chunk"], left["a"], left["b"]):
                u = _profiles(right, states)
                rows += expected(model, a, b, chunk, _ratios(np.concatenate([x for _, x in u]), model), [(s, len(x)) for s, x in u])
            out = pd.DataFrame(rows, columns=["slice", "chunk", "data"])
            give_back()
            return out

        return run

    def learn(prior: np.ndarray, last: bool):
        def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
            """u of a slice's words for each chunk, and sums: kind 1 has what the slice adds to Z, kind 2 sums of moves."""
            if not len(left):
                sums = np.sum([np.frombuffer(x) for x in right["data"]], axis=0)
                return pd.DataFrame([(2, 0, 0, None, None, sums)], columns=LEARNT_COLUMNS)
            gids = [_unsqueeze(x, "<i4") for x in left["gid"]]
            tfs = [_unsqueeze(x, "<i8") for x in left["tf"]]
            size = 1 + max(int(g.max()) for g in gids)
            e, c = np.zeros((size, states)), np.zeros(size, np.int64)
            sent = dict(zip(right["chunk"], right["data"]))
            for chunk, g, tf in zip(left["chunk"], gids, tfs):
                c[g] += tf
                if chunk in sent:
                    share = np.frombuffer(sent[chunk], "<u2").reshape(-1, states).astype(np.float64)
                    e[g] += share * (tf / np.maximum(share.sum(axis=1), 1))[:, None]
            u = ((e + SMOOTH * prior) / (c + SMOOTH)[:, None]).astype("<f2")
            z = ((c + (c > 0))[:, None] * u.astype(np.float64)).sum(axis=0)
            rows = [(0, chunk, s, u[g].tobytes(), _squeeze(c[g]) if last else None, None) for chunk, s, g in zip(left["chunk"], left["slice"], gids)]
            return pd.DataFrame([*rows, (1, 0, 0, None, None, z)], columns=LEARNT_COLUMNS)

        return run

    words = numbered.select("slice", "chunk", "gid", "tf").groupBy("slice")
    profile = None
    rounds = rounds if n_train else 0
    for turn in range(max(1, rounds)):
        if not rounds:
            sums = chunks.where("false").select(F.lit(0).alias("slice"), "chunk", F.col("a").alias("data"))
        elif not turn:
            sums = chunks.mapInPandas(first_round(model), SENT)
        else:
            sums = chunks.select("chunk", "a", "b").groupBy("chunk").cogroup(profile.where("kind = 0").select("chunk", "slice", "u").groupBy("chunk")).applyInPandas(next_round(model), SENT)
        prior = model["share"]
        before, profile = profile, materialise(words.cogroup(sums.groupBy("slice")).applyInPandas(learn(prior, turn + 1 >= rounds), LEARNT), "lm-profile", "uncompressed")
        if before is not None:
            discard(before)
        found = {1: np.zeros(states), 2: np.zeros(2 * states + states * states)}
        for r in profile.where("kind > 0").select("kind", F.posexplode("sums").alias("i", "x")).groupBy("kind", "i").agg(F.sum("x").alias("x")).collect():  # a few dozen rows
            found[r.kind][r.i] = r.x
        start, a, emit = np.split(found[2], [states, states + states * states])
        if rounds:
            start, a = _moves(start, a.reshape(states, states))
        else:
            start, a = model["start"], model["a"]
        # one unknown word beside the known ones
        z = (found[1] + prior.astype("<f2").astype(np.float64)) / denominator
        model = {"start": start, "a": a, "share": (emit + 1.0) / (emit.sum() + states), "z": z}
        spark._jvm.System.gc()  # else the round's shuffle files stay until the driver happens to collect its garbage
    return Trained(pieces, profile, model, n_train, denominator)


def _profiles(right: pd.DataFrame, states: int) -> list[tuple[int, np.ndarray]]:
    """(slice, u) of a chunk's words in the chunk's order."""
    return sorted(((int(s), np.frombuffer(u, "<f2").reshape(-1, states)) for s, u in zip(right["slice"], right["u"])), key=lambda x: x[0])


def lm_score(docs: DataFrame, folds: int = 7, held: int = 2, states: int = STATES, rounds: int = ROUNDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, held_out, n_tokens, n_known, train_tokens, base_score, score), one row per row of docs.

    Tokens are lower-cased (A-Z) words and an end. The model learns from all
    documents whose crc32(id) modulo folds is not `held`: exact counts for the
    add-one unigram (base_score), and `rounds` Baum-Welch rounds in which each
    word's expected counts are added up over all chunks. The starting point of those
    rounds is learnt from the same documents, all of them, in START_ROUNDS plainer rounds
    (words by bucket, one state for STRETCH words). score is the exact
    scaled forward sum over each whole text, log10.

    Null and empty texts have the end alone. A null id learns and is not held
    out. Repeated rows count each. With no training documents every word is unknown
    and the model is uniform. An empty table gives no rows; other columns are ignored.
    """
    done = train(docs, folds, held, states, rounds, id_col, text_col)
    model, denominator = done.model, done.denominator

    def score(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        order = np.argsort(right["slice"].to_numpy(), kind="stable")
        for a, b in zip(left["a"], left["b"]):
            c = np.concatenate([_unsqueeze(right["c"].iloc[i], "<i8") for i in order])
            log = np.log10((c + 1) / denominator)
            seqs, about = _documents(a, b)
            paths = _e_step(seqs, {"a": model["a"], "start": model["start"], "ratio": _ratios(np.concatenate([x for _, x in _profiles(right, states)]), model)}, None) / np.log(10)
            basic = np.array([log[s].sum() for s in seqs])
            out.append(pd.DataFrame({"id": about[:, 0], "fold": about[:, 1].astype(np.int32), "n_tokens": about[:, 2], "n_known": [int((c[s] > 0).sum()) for s in seqs], "base_score": basic, "score": basic + paths}))
        give_back()
        return pd.concat(out) if out else pd.DataFrame(columns=["id", "fold", "n_tokens", "n_known", "base_score", "score"])

    chunks = done.pieces.where("kind = 0").select("chunk", "a", "b")
    # a chunk's documents and the profiles of its words, which are bounded by CHUNK_BYTES and one text, meet in one task
    out = (
        chunks.groupBy("chunk")
        .cogroup(done.profile.where("kind = 0").select("chunk", "slice", "u", "c").groupBy("chunk"))
        .applyInPandas(score, "id bigint, fold int, n_tokens bigint, n_known bigint, base_score double, score double")
    )
    return out.select(unveiled().alias(id_col), (F.col("fold") == held).alias("held_out"), "n_tokens", "n_known", F.lit(done.n_train).cast("bigint").alias("train_tokens"), "base_score", "score")
