"""Language-model scores by a probabilistic suffix tree over words.

Tokens are the words of a text, A-Z in lower case, and one end.  A context is
the last one to ``DEPTH`` words; the states of the model are the root and the
contexts that a divergence test retains, and a token is scored in the state of
the longest suffix of its history that is one.

*Candidates.*  A gram (a context, or a context and its next token) is counted
when it occurs ``FLOOR`` times in the training texts, however many there are.

*Test.*  A context is retained if its count times the divergence of its
next-token distribution from that of its longest retained suffix, which is the
log-likelihood that it gains on the training texts, exceeds ``GAIN`` ln N, for
N training tokens.

*Smoothing.*  With c(s) the count of state s, K(s) the sum of its counted next
tokens and a = ``ESCAPE``,

    P(w | s) = c(sw) / (c(s) + a) + (c(s) - K(s) + a) / (c(s) + a) * P(w | longest retained suffix of s)

and at the root P(w) = (c(w) + 1) / (N + V + 1), V the number of different
training tokens; words never seen share the mass 1 / (N + V + 1).  Each state is
a proper distribution.

*Distribution.*  All contexts of a token end in the word before it, so tokens
are dealt out by that word: a bucket holds the whole subtree of each of its
words, and counts, tests and scores there.  A context of more than ``_HEAVY``
tokens (the word "the") has no bucket of its own.  Its grams are counted over all
chunks of text and joined back to them, its test is a sum over them, and its
tokens are dealt out by one word more.  Tokens go out in blobs, one a chunk and
bucket.  What a text gains in the states of a bucket comes back, as a whole number of
2^-32; texts that gain nothing there do not.

Chunks lie in files bucketed by their number, so that counts are shuffled to them and
they are never shuffled to counts.

Nothing that decides is gathered: the driver and the tasks hold the ``_HEAD`` most
frequent words, which get their numbers and counts at once where all others get
theirs by a join of (chunk, word), and at most N / ``_HEAVY`` contexts of each length.

Defined results: null, empty and blank texts have the end only; a null doc_id is
not held out; rows count each for itself, those that repeat too; an empty table
gives no rows, and without a training text all scores are 0; other columns are
ignored but for those carried.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clientele.sources.files import remove, scratch_dir
from clientele.sources.layout import bucketed_files

DEPTH = 3
GAIN = 2.0
ESCAPE = 1.0
# Least count of a gram and of the words in it.
FLOOR = 3
FOLDS, HELD_OUT = 7, 2
# Stands for the end of a text, which no word equals.
END = b""
# Codes of words: the count below the floor, from the floor on one for each word.
_WORDS = FLOOR
# Words that a task looks up without a join, tokens of a chunk, tokens from which a context
# is heavy: counted over the chunks, tokens of a bucket, and tokens scored at once; none of
# them changes a result.
_HEAD = 1 << 18
_CHUNK = 1 << 19
_HEAVY = 1 << 19
_BUCKET = 1 << 21
_SLICE = 1 << 18
# Parts of 1 that gains are rounded to; a text has at most one for each of its tokens.
_UNIT = 2.0**32
# Distinct words that a task holds before it hands them on.
_HELD_WORDS = 400_000
# Of words that are held out only, those that a task reports.
_OFTEN_OUT = 64


def held_out(doc_id: Column) -> Column:
    digits = F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")
    return doc_id.isNotNull() & (F.pmod(F.crc32(digits), F.lit(FOLDS)) == HELD_OUT)


def tokens(text: bytes) -> list[bytes]:
    """Bytes fold A-Z only, and part at the six ASCII blanks."""
    return [*text.lower().split(), END]


def floors(n_tokens: int) -> tuple[int, int]:
    """Least counts of grams and of words in them, the same for any number of tokens."""
    return FLOOR, FLOOR


def _find(keys: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Places of ``wanted`` in sorted ``keys``, -1 where it is not there."""
    if not len(keys):
        return np.full(len(wanted), -1, dtype=np.int64)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    return np.where(keys[at] == wanted, at, -1)


def _packed(*columns: np.ndarray) -> bytes:
    """Columns byte by byte, which compresses ids of a few bytes, under their length."""
    raw = b"".join(c.view(np.uint8).reshape(len(c), c.itemsize).T.tobytes() for c in columns)
    return len(columns[0]).to_bytes(8, "little") + pa.Codec("zstd").compress(raw, asbytes=True)


def _unpacked(blob: bytes, kinds: list) -> list[np.ndarray]:
    n = int.from_bytes(blob[:8], "little")
    widths = [np.dtype(k).itemsize for k in kinds]
    raw = np.frombuffer(pa.Codec("zstd").decompress(blob[8:], n * sum(widths), asbytes=True), dtype=np.uint8)
    parts = np.split(raw, np.cumsum(widths)[:-1] * n)
    return [np.ascontiguousarray(p.reshape(w, n).T).reshape(-1).view(k) for p, w, k in zip(parts, widths, kinds, strict=True)]


def _pair(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return (left << 32) | right


def _hashed(columns: list[np.ndarray]) -> np.ndarray:
    out = np.zeros(len(columns[0]), np.uint64)
    for c in columns:
        out = (out + c.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return out


@dataclass
class States:
    """Contexts with counts, sums of counted next tokens, and whether they are retained.

    ``keys`` pairs the place of the context without its first word with that word.
    """

    keys: np.ndarray
    counts: np.ndarray
    known: np.ndarray
    retained: np.ndarray

    def step(self, place: np.ndarray, seen: np.ndarray, below: np.ndarray) -> np.ndarray:
        """P in the states at ``place`` where they are retained, else ``below``."""
        c, k = self.counts[place], self.known[place]
        return np.where(self.retained[place], (seen + (c - k + ESCAPE) * below) / (c + ESCAPE), below)


@dataclass
class Model:
    """Sums over the training tokens, the frequent words, and the states with many occurrences, by length."""

    head: dict[bytes, int]
    head_counts: np.ndarray
    often: np.ndarray
    n_tokens: int
    n_distinct: int
    buckets: int
    depth: int
    gain: float
    heavy: list[States]

    @property
    def root(self) -> int:
        return self.n_tokens + self.n_distinct + 1

    def rates(self, codes: np.ndarray, rare: np.ndarray) -> np.ndarray:
        """P at the root; ``rare`` has the counts of words that are not frequent."""
        counts = np.r_[np.arange(_WORDS), self.head_counts]
        return (np.where(codes < len(counts), counts[np.minimum(codes, len(counts) - 1)], rare) + 1) / self.root

    @property
    def least_gain(self) -> float:
        return self.gain * math.log(max(2, self.n_tokens))


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts over the training texts, and everywhere; words of few tokens that are held out only are left."""
    held: Counter[bytes] = Counter()
    out: Counter[bytes] = Counter()

    def counted() -> pa.RecordBatch:
        words = [w for w, n in held.items() if n > out[w] or n >= _OFTEN_OUT]
        counts = pa.RecordBatch.from_arrays(
            [pa.array(words, pa.binary()), pa.array([held[w] - out[w] for w in words], pa.int64()),
             pa.array([held[w] for w in words], pa.int64())], ["word", "n", "everywhere"])
        held.clear()
        out.clear()
        return counts

    for batch in batches:
        for text, is_out in zip(batch.column("text"), batch.column("held_out"), strict=True):
            read = tokens(text.as_py())
            held.update(read)
            if is_out.as_py() is not False:
                out.update(read)
            if len(held) >= _HELD_WORDS:
                yield counted()
    yield counted()


class _Codes(dict):
    """Places of the frequent words, and -1 less the places of others in the order they come."""

    def __init__(self, head: dict[bytes, int]):
        super().__init__(head)
        self.others: list[bytes] = []

    def __missing__(self, word: bytes) -> int:
        self.others.append(word)
        self[word] = -len(self.others)
        return self[word]

    def forget(self) -> None:
        for word in self.others:
            del self[word]
        self.others = []


def _encoder(sent):
    """One row per text, and one per chunk with all its tokens.

    A token is the place of its word among the frequent ones, or -1 less the place among the others of the chunk.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codes = _Codes(sent.value.head)
        chunk = TaskContext.get().partitionId() << 20
        for batch in batches:
            texts, start = batch.column("text"), 0
            coded, lengths, size = [], [], 0
            for i in range(len(texts)):
                read = tokens(texts[i].as_py())
                coded.append(np.fromiter(map(codes.__getitem__, read), np.int32, len(read)))
                lengths.append(len(read))
                size += len(read)
                if size < _CHUNK and i + 1 < len(texts):
                    continue
                part = batch.slice(start, len(lengths))
                n = np.array(lengths, dtype=np.int64)
                out = np.array([v is not False for v in part.column("held_out").to_pylist()], dtype=np.uint8)

                columns = {
                    "key": pa.array((chunk << 21) + np.arange(len(n))), "row": part.column("row"),
                    "held_out": part.column("held_out"), "n_tokens": pa.array(n),
                    "chunk": pa.array([chunk]), "ids": pa.array([_packed(np.concatenate(coded))], pa.binary()),
                    "lengths": pa.array([n.tobytes()], pa.binary()), "out": pa.array([out.tobytes()], pa.binary()),
                    "words": pa.array([codes.others], pa.list_(pa.binary()))}
                for is_chunk, rows in ((False, len(n)), (True, 1)):
                    yield pa.RecordBatch.from_arrays(
                        [c if is_chunk == (k > 3) else pa.nulls(rows, c.type) for k, c in enumerate(columns.values())]
                        + [pa.array([is_chunk] * rows)], [*columns, "is_chunk"])
                chunk, start = chunk + 1, i + 1
                coded, lengths, size = [], [], 0
                codes.forget()

    return encode


def _resolver(sent):
    """Codes of tokens: counts below the floor, then the frequent words and the others by their numbers.

    ``counts`` are those of the others among them, in their order.
    """

    def resolve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        head = np.where(model.head_counts >= FLOOR, np.arange(len(model.head_counts)) + _WORDS, model.head_counts)
        for batch in batches:
            codes, others = [], []
            for ids, words, found in zip(batch.column("ids"), batch.column("words").to_pylist(), batch.column("found"), strict=True):
                ids = _unpacked(ids.as_py(), [np.int32])[0].astype(np.int64)
                number, count = np.zeros(words, np.int64), np.zeros(words, np.int64)
                if found.is_valid and len(found):
                    place, n = (found.values.field(k).to_numpy() for k in ("place", "n"))
                    number[place] = np.where(n >= FLOOR, found.values.field("number").to_numpy() + _WORDS + len(head), n)
                    count[place] = n
                code = np.r_[head, number[::-1]][ids] if len(head) + len(number) else ids
                codes.append(_packed(code.astype(np.uint32)))
                others.append(np.r_[np.zeros(len(head), np.int64), count[::-1]][ids][code >= _WORDS + len(head)].tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column("chunk"), pa.array(codes, pa.binary()), pa.array(others, pa.binary()),
                 batch.column("lengths"), batch.column("out")], ["chunk", "codes", "counts", "lengths", "out"])

    return resolve


class _Chunk:
    """The tokens of a chunk with the words before them, and P in the states with many occurrences."""

    def __init__(self, model: Model, codes: bytes, counts: bytes, lengths: bytes, out: bytes):
        self.model = model
        self.codes = _unpacked(codes, [np.uint32])[0]
        lengths = np.frombuffer(lengths, dtype=np.int64)
        self.starts = np.cumsum(np.r_[0, lengths])[:-1]
        self.text = np.repeat(np.arange(len(lengths), dtype=np.uint32), lengths)
        self.trained = np.frombuffer(out, dtype=np.uint8)[self.text] == 0
        first = np.zeros(len(self.codes), dtype=bool)
        first[self.starts] = True
        table = np.r_[np.arange(_WORDS), model.head_counts]
        self.counts = table[np.minimum(self.codes, len(table) - 1)]
        self.counts[self.codes >= len(table)] = np.frombuffer(counts, dtype=np.int64)
        # Words before, 0 from the first on that has no grams.
        self.before, word, last = [], np.where(self.codes >= _WORDS, self.codes, np.uint32(0)), np.ones(len(self.codes), bool)
        for _ in range(model.depth):
            word = np.where(first, np.uint32(0), np.r_[np.uint32(0), word[:-1]])
            last = last & (word > 0)
            self.before.append(np.where(last, word, np.uint32(0)))
        self.below = (self.counts + 1) / model.root
        self.level = np.zeros(len(self.codes), np.int8)
        self.state = np.zeros(len(self.codes), np.uint32)
        # By length of heavy contexts, the count of the gram at each token.
        self.seen: list[np.ndarray] = []

    def rare_counts(self) -> np.ndarray:
        """Counts of words that are not frequent, so at most one in ``_HEAD`` of all tokens; else 0."""
        return np.where(self.codes >= _WORDS + len(self.model.head_counts), self.counts, 0).astype(np.uint32)

    def grams(self, level: int) -> tuple[np.ndarray, ...]:
        """Tokens whose context of ``level`` + 1 words may be heavy: their places, the keys of their
        contexts, the places of the first of each gram, the gram of each, and the buckets of grams."""
        word = self.before[level]
        at = np.flatnonzero((self.level == level) & (_find(self.model.often, word) >= 0))
        key = _pair(self.state[at].astype(np.int64), word[at].astype(np.int64))
        _, context = np.unique(key, return_inverse=True)
        _, some, gram = np.unique(_pair(context, self.codes[at].astype(np.int64)), return_index=True, return_inverse=True)
        bucket = _hashed([key[some], self.codes[at[some]]]) % np.uint64(self.model.buckets)
        return at, key, some, gram, bucket.astype(np.int64)

    def enter(self, level: int, found) -> None:
        """Steps into the states of ``level`` + 1 words by the counts of the grams that were found."""
        at, key, some, gram, bucket = self.grams(level)
        states = self.model.heavy[level]
        seen = np.zeros(len(some), np.int64)
        if found.is_valid and len(found):
            parts = sorted(found.as_py(), key=lambda part: part["bucket"])
            seen[np.argsort(bucket, kind="stable")] = np.concatenate([_unpacked(p["seen"], [np.uint64])[0] for p in parts])
        state = _find(states.keys, key)
        inside = state >= 0
        at, state, seen = at[inside], state[inside], seen[gram[inside]]
        self.seen.append(np.zeros(len(self.codes), np.uint32))
        self.seen[level][at] = seen
        self.below[at] = states.step(state, seen, self.below[at])
        self.level[at] = level + 1
        self.state[at] = state


def _chunk(model: Model, batch: pa.RecordBatch, i: int) -> _Chunk:
    chunk = _Chunk(model, *(batch.column(c)[i].as_py() for c in ("codes", "counts", "lengths", "out")))
    for level in range(len(model.heavy)):
        chunk.enter(level, batch.column(f"found{level}")[i])
    return chunk


def _gram_counter(sent):
    """Grams of contexts that may be heavy, counted by chunk and dealt out, with what gives P below:
    the counts of their words and of the shorter grams."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        for batch in batches:
            for i, number in enumerate(batch.column("chunk").to_pylist()):
                chunk = None  # One at once.
                chunk = _chunk(model, batch, i)
                at, key, some, gram, bucket = chunk.grams(len(model.heavy))
                trained = np.bincount(gram, chunk.trained[at], len(some)).astype(np.uint32)
                out = np.bincount(gram, minlength=len(some)).astype(np.uint32) - trained
                first = at[some]
                columns = [key[some], chunk.codes[first], trained, out, *(c[first] for c in chunk.seen), chunk.rare_counts()[first]]
                order = np.argsort(bucket, kind="stable")
                columns = [c[order] for c in columns]
                buckets, starts = np.unique(bucket[order], return_index=True)
                cuts = [*starts.tolist(), len(order)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(buckets, pa.int64()), pa.array(np.full(len(buckets), number)),
                     pa.array([_packed(*(c[a:b] for c in columns)) for a, b in zip(cuts, cuts[1:], strict=False)], pa.binary())],
                    ["bucket", "chunk", "packed"])

    return count


def _gram_summer(sent):
    """Counts of the grams of a bucket: for each chunk, those of its grams that reach the floor; once, the
    sums of their contexts, and the grams that reach the floor."""
    kind = pa.schema([("bucket", pa.int64()), ("chunk", pa.int64()), ("seen", pa.binary()),
                      ("contexts", pa.binary()), ("grams", pa.binary()), ("most", pa.int64())])

    def below(keys: np.ndarray, words: np.ndarray, seen: list[np.ndarray], rare: np.ndarray) -> np.ndarray:
        """P in the states without the first word of each context."""
        model, places = sent.value, []
        for states in reversed(model.heavy):
            places.append(keys >> 32)
            keys = states.keys[places[-1]]
        out = model.rates(words, rare)
        for states, place, n in zip(model.heavy, reversed(places), seen, strict=True):
            out = states.step(place, n, out)
        return out

    def summed(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        chunks = table.column("chunk").to_pylist()
        kinds = [np.int64, *[np.uint32] * (4 + len(sent.value.heavy))]
        parts = [_unpacked(b, kinds) for b in table.column("packed").to_pylist()]
        keys, words, trained, out, *shorter, rare = (np.concatenate(c) for c in zip(*parts, strict=True))
        contexts, context = np.unique(keys, return_inverse=True)
        _, first, gram = np.unique(_pair(context, words.astype(np.int64)), return_index=True, return_inverse=True)
        n, of = np.bincount(gram, trained), context[first]
        seen = np.where((n >= FLOOR) & (words[first] >= _WORDS), n, 0).astype(np.uint64)
        everywhere = np.bincount(context, trained) + np.bincount(context, out)
        sums = [np.bincount(of, c).astype(np.uint64) for c in (n, seen)] + [everywhere.astype(np.uint64)]
        most = np.where(words[first] >= _WORDS, n + np.bincount(gram, out), 0).max()
        some, cuts, none = seen > 0, np.cumsum([len(p[0]) for p in parts])[:-1], [None] * len(chunks)
        at = first[some]
        counted = _packed(keys[at], seen[some], below(keys[at], words[at], [c[at] for c in shorter], rare[at]))
        return pa.table(
            [[key[0].as_py()] * (len(chunks) + 1), [*chunks, None], [*(_packed(c) for c in np.split(seen[gram], cuts)), None],
             [*none, _packed(contexts, *sums)], [*none, counted], [*none, int(most)]], schema=kind)

    return summed


def _context_sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for blob in batch.column("contexts"):
            columns = _unpacked(blob.as_py(), [np.int64] * 4)
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["context", "c", "k", "everywhere"])


def _gainer(sent):
    """What the contexts gain by the grams of a bucket."""

    def gains(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts, known = sent.value
        for batch in batches:
            for blob in batch.column("grams"):
                context, seen, below = _unpacked(blob.as_py(), [np.int64, np.uint64, np.float64])
                at = _find(keys, context)
                at, seen, below = at[at >= 0], seen[at >= 0], below[at >= 0]
                inside = (seen + (counts[at] - known[at] + ESCAPE) * below) / (counts[at] + ESCAPE)
                gained = np.bincount(at, seen * np.log(inside / below), len(keys)).astype(np.float64)
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(gained)], ["context", "gained"])

    return gains


_SUMS = [np.uint32, np.float64, np.float64, np.int64]
_GAINS = [np.uint32, np.uint64]


def _dealer(sent):
    """Deals tokens out by the last word of their history, by more of it while that has many occurrences.

    The logarithms of P in the states with many occurrences are summed by text here, in bucket -1 less the chunk.
    """

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        for batch in batches:
            for i, number in enumerate(batch.column("chunk").to_pylist()):
                chunk = None  # One at once.
                chunk = _chunk(model, batch, i)
                n = len(chunk.starts)
                if not n:
                    continue
                done = chunk.level == model.depth
                for k, word in enumerate(chunk.before):
                    done |= (chunk.level == k) & (word == 0)
                score = np.bincount(chunk.text, np.log10(chunk.below), n)
                base = np.add.reduceat(np.log10((chunk.counts + 1) / model.root), chunk.starts)
                known = np.add.reduceat((chunk.counts > 0).astype(np.int64), chunk.starts)
                rows = [(-1 - number, -1, _packed(np.arange(n, dtype=np.uint32), score, base, known))]
                at = np.flatnonzero(~done)
                bucket = _hashed([np.where(chunk.level[at] >= k, w[at], 0) for k, w in enumerate(chunk.before)])
                bucket = (bucket % np.uint64(model.buckets)).astype(np.int64) * (model.depth + 1) + chunk.level[at]
                # The words of a bucket one after the other, and texts in their order, which compresses best.
                order = np.argsort((bucket << 32) | chunk.before[0][at].astype(np.int64), kind="stable")
                at, bucket = at[order], bucket[order]
                columns = [c[at] for c in [*chunk.before, chunk.codes, chunk.text * 2 + chunk.trained]]
                seen, rare = [c[at] for c in chunk.seen], chunk.rare_counts()[at]
                cuts = np.flatnonzero(np.diff(bucket, prepend=-1, append=-1)).tolist()
                for start, stop in zip(cuts, cuts[1:], strict=False):
                    to, level = divmod(int(bucket[start]), model.depth + 1)
                    rows.append((to, level, _packed(*(c[start:stop] for c in [*columns, *seen[:level], rare]))))
                buckets, levels, blobs = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(buckets, pa.int64()), pa.array([number] * len(rows), pa.int64()), pa.array(levels, pa.int32()),
                     pa.array(blobs, pa.binary())], ["bucket", "chunk", "level", "packed"])

    return deal


def _probabilities(model: Model, level: int, before: list[np.ndarray], word: np.ndarray, trained: np.ndarray,
                   below: np.ndarray) -> np.ndarray:
    """P of tokens in the state of the longest retained suffix of their history, of which ``below``
    knows ``level`` words; all tokens after the same ``level`` + 1 words are given."""
    out, at, context = below.copy(), np.arange(len(word)), np.zeros(len(word), np.int64)
    for length, words in enumerate(before):
        if length > level:
            some = words[at] > 0
            at, context = at[some], context[some]
        if not len(at):
            break
        _, context = np.unique(_pair(context, words[at]), return_inverse=True)
        if length < level:
            continue
        counts = np.bincount(context, trained[at])
        # Contexts that occur less often have no counted gram, nor have longer ones.
        some = counts[context] >= FLOOR
        at, context = at[some], context[some]
        _, first, gram = np.unique(_pair(context, word[at]), return_index=True, return_inverse=True)
        seen = np.bincount(gram, trained[at], len(first))
        seen = np.where((seen >= FLOOR) & (word[at[first]] >= _WORDS), seen, 0)
        of, n = context[first], len(counts)
        known = np.bincount(of, seen, n)
        rest, under = counts - known, out[at[first]]
        inside = (seen + (rest[of] + ESCAPE) * under) / (counts[of] + ESCAPE)
        gained = np.bincount(of, seen * np.log(inside / under), n) + rest * np.log((rest + ESCAPE) / (counts + ESCAPE))
        states = States(np.arange(n), counts, known, (gained > model.least_gain) & (known > 0))
        out[at] = states.step(context, seen[gram], out[at])
    return out


def _scorer(sent):
    """What the logarithms of P gain over those that the dealer summed, by chunk and text, from the tokens of a bucket."""
    kind = pa.schema([("chunk", pa.int64()), ("packed", pa.binary()), ("whole", pa.bool_())])

    def scored(level: int, blobs: list[bytes]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Texts and gains, by blob, of tokens that know ``level`` words."""
        model = sent.value
        depth, n_columns = model.depth, model.depth + 3 + level
        ends = np.cumsum([int.from_bytes(b[:8], "little") for b in blobs])
        n_slices = 1 + int(ends[-1]) // _SLICE
        columns, part = np.empty((n_columns, ends[-1]), np.uint32), np.empty(ends[-1], np.uint16)
        for blob, end in zip(blobs, ends.tolist(), strict=True):
            read = _unpacked(blob, [np.uint32] * n_columns)
            columns[:, end - len(read[0]):end] = read
            part[end - len(read[0]):end] = (_hashed(read[:level + 1]) >> np.uint64(40)) % np.uint64(n_slices)
        text, logs = columns[depth + 1], np.empty(ends[-1])
        # Some contexts at once, whole ones.
        for number in range(n_slices):
            at = np.flatnonzero(part == number)
            *before, word = (c[at].astype(np.int64) for c in columns[:depth + 1])
            rare, state = columns[-1][at], np.zeros(len(at), np.int64)
            below = model.rates(word, rare)
            for states, last, n in zip(model.heavy, before, columns[depth + 2:-1], strict=False):
                state = _find(states.keys, _pair(state, last))
                below = states.step(state, n[at].astype(np.int64), below)
            logs[at] = np.log10(_probabilities(model, level, before, word, text[at] & 1 == 1, below)) - np.log10(below)
        text = text >> np.uint32(1)
        return list(zip(np.split(text, ends[:-1]), np.split(logs, ends[:-1]), strict=True))

    def score(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        chunks, levels, blobs = (table.column(c).to_pylist() for c in ("chunk", "level", "packed"))
        if key[0].as_py() < 0:
            return pa.table([chunks, blobs, [True] * len(chunks)], schema=kind)
        by_chunk: dict[int, list] = {}
        for level in sorted(set(levels)):
            some = [i for i, k in enumerate(levels) if k == level]
            for i, logs in zip(some, scored(level, [blobs[i] for i in some]), strict=True):
                by_chunk.setdefault(chunks[i], []).append(logs)
        gains = {}
        for chunk, parts in by_chunk.items():
            text, logs = (np.concatenate(c) for c in zip(*parts, strict=True))
            gained = np.rint(np.bincount(text, logs) * _UNIT).astype(np.int64)
            texts = np.flatnonzero(gained)
            if len(texts):
                # Steps between texts, and signs in the last bit, leave the most bytes zero.
                signed = (gained[texts] << 1) ^ (gained[texts] >> 63)
                gains[chunk] = _packed(np.diff(texts, prepend=0).astype(np.uint32), signed.view(np.uint64))
        return pa.table([list(gains), list(gains.values()), [False] * len(gains)], schema=kind)

    return score


def _summed(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """Scores of the texts of a chunk."""
    blobs, whole = table.column("packed").to_pylist(), table.column("whole").to_pylist()
    _, score, base, known = _unpacked(blobs[whole.index(True)], _SUMS)
    total = np.zeros(len(score), np.int64)
    for blob, is_whole in zip(blobs, whole, strict=True):
        if not is_whole:
            steps, signed = _unpacked(blob, _GAINS)
            gained = signed.view(np.int64)
            total[np.cumsum(steps, dtype=np.int64)] += ((gained >> 1) & (2**63 - 1)) ^ -(gained & 1)
    score = score + total / _UNIT
    return pa.table([(key[0].as_py() << 21) + np.arange(len(score)), known, base, score],
                    names=["key", "n_known", "base_score", "score"])


def _heavy_states(chunks: DataFrame, model: Model, folder: str, files: int) -> tuple[States, DataFrame, bool]:
    """The heavy states of the next length, the chunks with the counts of their grams, and
    whether longer ones are heavy: a context of one word more is a gram here.

    The chunks lie in ``files`` buckets, where the counts are sent."""
    spark, level = chunks.sparkSession, len(model.heavy)
    sent = spark.sparkContext.broadcast(model)
    chunks.mapInArrow(_gram_counter(sent), "bucket long, chunk long, packed binary").repartition(model.buckets, "bucket").groupBy("bucket").applyInArrow(
        _gram_summer(sent), "bucket long, chunk long, seen binary, contexts binary, grams binary, most long",
    ).write.parquet(f"{folder}/grams{level}")
    sent.unpersist()
    grams = spark.read.parquet(f"{folder}/grams{level}")
    # At most one context in _HEAVY tokens.
    contexts = grams.where("contexts is not null").select("contexts").mapInArrow(
        _context_sums, "context long, c long, k long, everywhere long",
    ).groupBy("context").agg(F.sum("c").alias("c"), F.sum("k").alias("k"), F.sum("everywhere").alias("everywhere")).where(
        F.col("everywhere") >= _HEAVY).select("context", "c", "k").toArrow()
    keys, c, k = (contexts.column(i).to_numpy() for i in range(3))
    order = np.argsort(keys)
    keys, c, k = keys[order], c[order], k[order]
    sent = spark.sparkContext.broadcast((keys, c, k))
    tested = grams.where("grams is not null").select("grams").mapInArrow(
        _gainer(sent), "context long, gained double").groupBy("context").agg(F.sum("gained").alias("gained")).toArrow()
    gained = np.zeros(len(keys))
    gained[_find(keys, tested.column("context").to_numpy())] = tested.column("gained").to_numpy()
    sent.unpersist()
    gained += (c - k) * np.log((c - k + ESCAPE) / (c + ESCAPE))
    states = States(keys, c, k, (gained > model.least_gain) & (k > 0))
    found = grams.where("chunk is not null").repartition(files, "chunk").groupBy("chunk").agg(
        F.collect_list(F.struct("bucket", "seen")).alias(f"found{level}"))
    most = grams.agg(F.max("most")).first()[0]
    return states, chunks.join(found, "chunk", "left"), (most or 0) >= _HEAVY


def _numbered(spark: SparkSession, counts: DataFrame) -> DataFrame:
    """Words numbered from 0, without a gap."""
    part = F.shiftright("id", 33)
    sizes = counts.groupBy(part.alias("part")).agg(F.count("*").alias("n")).orderBy("part").collect()
    ends = np.cumsum([0, *(r["n"] for r in sizes)]).tolist()
    starts = spark.createDataFrame([(r["part"], s) for r, s in zip(sizes, ends, strict=False)], "part long, start long")
    return counts.withColumn("part", part).join(F.broadcast(starts), "part").select(
        "word", "n", (F.col("start") + F.col("id").bitwiseAND(F.lit((1 << 33) - 1))).alias("number"))


def _head(counts: DataFrame) -> pa.Table:
    """The words that occur most often, at most ``_HEAD``."""
    floor, total = None, 0
    for r in counts.groupBy("everywhere").count().orderBy(F.desc("everywhere")).limit(_HEAD).collect():
        total += r["count"]
        if total > _HEAD:
            break
        floor = r["everywhere"]
    return counts.where(F.col("everywhere") >= floor if floor else F.lit(False)).select("word", "n", "everywhere").toArrow().sort_by(
        [("everywhere", "descending"), ("word", "ascending")])


def score_documents(docs: DataFrame, carry: list[str], is_held_out: Column,
                    depth: int = DEPTH, gain: float = GAIN) -> DataFrame:
    """``row`` (the carried columns), held_out, n_tokens, n_known, train_tokens, base_score and score.

    ``is_held_out`` marks the rows that are scored only.
    """
    spark = docs.sparkSession
    folder = scratch_dir(spark, "suffixtree")
    text = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary").alias("text")
    texts = docs.select(F.struct(*carry).alias("row"), is_held_out.alias("held_out"), text)
    counted = texts.select("held_out", "text").mapInArrow(_count_words, "word binary, n long, everywhere long")
    # Tasks have added up their own words.
    counted.repartition(F.col("word")).groupBy("word").agg(
        F.sum("n").alias("n"), F.sum("everywhere").alias("everywhere"),
    ).where(F.col("n") > 0).withColumn("id", F.monotonically_increasing_id()).write.parquet(f"{folder}/words")
    counts = spark.read.parquet(f"{folder}/words")
    n_distinct, n_tokens = counts.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    head = _head(counts)
    words, n, everywhere = head.column("word").to_pylist(), head.column("n").to_numpy(), head.column("everywhere").to_numpy()
    often = np.flatnonzero((everywhere >= _HEAVY) & (n >= FLOOR)) + _WORDS
    model = Model({w: i for i, w in enumerate(words)}, n.astype(np.int64), often, n_tokens, n_distinct, 1, depth, gain, [])

    sent = spark.sparkContext.broadcast(model)
    kind = (f"key long, row {texts.dtypes[0][1]}, held_out boolean, n_tokens long, "
            "chunk long, ids binary, lengths binary, out binary, words array<binary>, is_chunk boolean")
    files = 1 + n_tokens // _BUCKET
    with bucketed_files(texts.mapInArrow(_encoder(sent), kind), f"{folder}/coded", "chunk", files, "is_chunk") as coded:
        chunks = coded.where("is_chunk")
        # Words that are not frequent get their numbers and counts in one shuffle of (chunk, word).
        found = chunks.select("chunk", F.posexplode("words").alias("place", "word")).join(
            _numbered(spark, counts), "word").repartition(files, "chunk").groupBy("chunk").agg(
            F.collect_list(F.struct("place", "n", "number")).alias("found"))
        resolved = chunks.select("chunk", "ids", "lengths", "out", F.size("words").alias("words")).join(found, "chunk", "left").mapInArrow(
            _resolver(sent), "chunk long, codes binary, counts binary, lengths binary, out binary")
        with bucketed_files(resolved, f"{folder}/chunks", "chunk", files) as chunks:
            pass
    sent.unpersist()
    # The words are not read again.
    for read in ("words", "coded/is_chunk=true"):
        remove(spark, f"{folder}/{read}")
    coded = spark.read.schema(kind).parquet(f"{folder}/coded").where("not is_chunk")
    model.head = {}
    size = coded.agg(F.coalesce(F.sum("n_tokens"), F.lit(0))).first()[0]
    model.buckets = 1 + size // _BUCKET
    more = len(often) > 0
    while more and len(model.heavy) < depth:
        states, chunks, more = _heavy_states(chunks, model, folder, files)
        model.heavy.append(states)

    sent = spark.sparkContext.broadcast(model)
    sums = chunks.mapInArrow(_dealer(sent), "bucket long, chunk long, level int, packed binary").repartition(model.buckets, "bucket").groupBy("bucket").applyInArrow(
        _scorer(sent), "chunk long, packed binary, whole boolean")
    scores = sums.groupBy("chunk").applyInArrow(_summed, "key long, n_known long, base_score double, score double")
    return coded.select("key", "row", "held_out", "n_tokens").join(scores, "key").select(
        "row", "held_out", "n_tokens", "n_known", F.lit(n_tokens).cast("long").alias("train_tokens"), "base_score", "score")
