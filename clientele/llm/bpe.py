"""BPE encoding and decoding with a transducer lexicon for frequent words.

Words of the whole corpus are counted; those that make up 1/``LEXICON_WORDS`` of
it or more, which bounds their number, are merged once, in one task, and
compiled into a minimal acyclic transducer with their ids (see ``lexicon``).  Its
file is written to the shared folder and given to all executors, whose Python
workers map it into memory.  Words that the
transducer does not know are merged exactly, pair by pair in rank order, and
remembered by a worker up to a bound.

Text is treated as the tokenizer file prescribes for this kind of model: special
tokens are cut out of the raw text, the rest is normalised (NFC, lower case
character by character), cut into words by the file's pattern and mapped to
byte symbols, the last with the word-end suffix.  Decoding joins the tokens by
spaces, as a tokenizer without a decoder does.

Defined results: null and empty texts have no ids, and no ids decode to the empty
text; texts are encoded whole, whatever their length; repeated rows are encoded
each for itself; an empty table gives no rows; all other columns are kept, and
the names of new columns are the caller's choice.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import unicodedata
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clientele.llm.lexicon import NOT_FOUND, Lexicon, compile_words
from clientele.sources.files import cut_lineage, remove_at_end, shared_dir

LEXICON_WORDS = 262_144
_CACHE_WORDS = 80_000
_ID_BITS = 17
_ID_MASK = (1 << _ID_BITS) - 1
_NO_PAIR = 1 << 62
# Symbols up to which a word is merged by looking over all of its pairs.
_SHORT_WORD = 64
# Characters of text whose words are looked up together.
_GROUP_CHARS = 1_000_000
_PIECE_ROWS = 500


def byte_symbols() -> list[str]:
    """Printable stand-ins of the 256 bytes in byte-level vocabularies."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in plain]
    symbols = {b: chr(b) for b in plain} | {b: chr(256 + n) for n, b in enumerate(others)}
    return [symbols[b] for b in range(256)]


class Vocabulary:
    """Merges, ids and text rules of a tokenizer file."""

    def __init__(self, content: str):
        spec = json.loads(content)
        model = spec["model"]
        if model["type"] != "BPE" or spec["decoder"] is not None or spec["post_processor"] is not None:
            raise ValueError("only BPE files without decoder and post-processor are supported")
        normal = [n["type"] for n in spec["normalizer"]["normalizers"]]
        steps = spec["pre_tokenizer"]["pretokenizers"]
        if normal != ["NFC", "Replace", "Lowercase"] or [s["type"] for s in steps] != ["Split", "ByteLevel"]:
            raise ValueError("unknown text rules")
        self.ids: dict[str, int] = model["vocab"]
        self.suffix: str = model["end_of_word_suffix"] or ""
        if len(self.ids) > _ID_MASK:
            raise ValueError("too many tokens")
        pairs = (m.split(" ") if isinstance(m, str) else m for m in model["merges"])
        # Pair of ids to rank and merged id, each pair as one integer.
        self.pairs = {
            self.ids[a] << _ID_BITS | self.ids[b]: rank << _ID_BITS | self.ids[a + b] for rank, (a, b) in enumerate(pairs)}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = {i: t for t, i in (self.ids | self.special).items()}
        cut = "|".join(map(regex.escape, sorted(self.special, key=len, reverse=True)))
        self.special_pattern = regex.compile(f"({cut})") if cut else None
        # White space as Unicode has it, also where \\s of this library differs.
        pattern = steps[0]["pattern"]["Regex"].replace(r"[^\s", r"[^\p{White_Space}")
        self.words = regex.compile(pattern).findall
        symbols = byte_symbols()
        self.inner, self.final = [self.ids[b] for b in symbols], [self.ids[b + self.suffix] for b in symbols]

    def pieces(self, text: str) -> Iterator[str]:
        """Words and special tokens of a text, in order."""
        parts = self.special_pattern.split(text) if self.special_pattern else [text]
        for part in parts:
            if part in self.special:
                yield part
            elif part:
                # One final sigma rule less than str.lower, which looks at neighbours.
                yield from self.words(unicodedata.normalize("NFC", part).replace("Σ", "σ").lower())

    def merge(self, word: str) -> list[int]:
        """Ids of one word by exact merging: lowest rank first, then leftmost."""
        coded = word.encode("utf-8", "surrogatepass")
        if not coded:
            return []
        ids = [self.inner[b] for b in coded]
        ids[-1] = self.final[coded[-1]]
        return self._merge_short(ids) if len(ids) <= _SHORT_WORD else self._merge_long(ids)

    def _merge_short(self, ids: list[int]) -> list[int]:
        find, none = self.pairs.get, _NO_PAIR
        ranks = [find(a << _ID_BITS | b, none) for a, b in zip(ids, ids[1:])]
        while ranks:
            best = min(ranks)
            if best == none:
                break
            i = ranks.index(best)
            ids[i] = best & _ID_MASK
            del ids[i + 1], ranks[i]
            if i:
                ranks[i - 1] = find(ids[i - 1] << _ID_BITS | ids[i], none)
            if i < len(ranks):
                ranks[i] = find(ids[i] << _ID_BITS | ids[i + 1], none)
        return ids

    def _merge_long(self, ids: list[int]) -> list[int]:
        """The same with a heap over linked symbols, for words without an end."""
        n, find = len(ids), self.pairs.get
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(found, i, ids[i], ids[i + 1]) for i in range(n - 1)
                if (found := find(ids[i] << _ID_BITS | ids[i + 1])) is not None]
        heapq.heapify(heap)
        while heap:
            found, i, left, right = heapq.heappop(heap)
            j = after[i]
            if ids[i] != left or j >= n or ids[j] != right:
                continue
            ids[i], ids[j] = found & _ID_MASK, -1
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b < n:
                    found = find(ids[a] << _ID_BITS | ids[b])
                    if found is not None:
                        heapq.heappush(heap, (found, a, ids[a], ids[b]))
        return [i for i in ids if i >= 0]


class Encoder:
    """Looks words up in the lexicon, merges the others and remembers them."""

    def __init__(self, vocabulary: Vocabulary, lexicon: Lexicon):
        self.vocabulary, self.lexicon = vocabulary, lexicon
        # Words in use and those of a while ago.
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def _learn(self, words: set[str]) -> None:
        if len(self.known) > _CACHE_WORDS:
            self.older, self.known = self.known, {}
        known, older, special = self.known, self.older, self.vocabulary.special
        new = []
        for word in words.difference(known):
            ids = older.get(word)
            if ids is None:
                new.append(word)
            else:
                known[word] = ids
        ranks = self.lexicon.ranks([w.encode("utf-8", "surrogatepass") for w in new])
        for word, rank in zip(new, ranks.tolist(), strict=True):
            if word in special:
                ids = [special[word]]
            else:
                ids = self.vocabulary.merge(word) if rank == NOT_FOUND else self.lexicon.ids_of(rank)
            known[word] = np.array(ids, dtype=np.int32).tobytes()

    def encode(self, texts: Iterable[str | None]) -> Iterator[bytes]:
        """Little-endian int32 ids of each text."""
        group: list[list[str]] = []
        held = 0
        for text in texts:
            group.append(list(self.vocabulary.pieces(text)) if text else [])
            held += len(text or "")
            if held >= _GROUP_CHARS:
                yield from self._flush(group)
                group, held = [], 0
        yield from self._flush(group)

    def _flush(self, group: list[list[str]]) -> Iterator[bytes]:
        self._learn(set().union(*group))
        for words in group:
            yield b"".join(map(self.known.__getitem__, words))


def frequent_words(texts: DataFrame, limit: int = LEXICON_WORDS) -> DataFrame:
    """Runs of letters, in lower case, that make up 1/``limit`` of all or more.

    There can be no more than ``limit`` of them, whatever the corpus.
    """
    parts = F.split(F.lower(F.col("text").cast("string")), r"[^\p{L}]+")
    counts = cut_lineage(
        texts.select(F.explode(parts).alias("word")).where("word != ''").groupBy("word").count())
    every = counts.agg(F.sum("count")).first()[0] or 0
    return counts.where(F.col("count") >= every / limit).select("word")


def _compiler(sent):
    """Compiles a lexicon of all words that it is given, which are one word to the vocabulary as well."""

    def compile_all(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = Vocabulary(sent.value)
        entries = {
            w.encode(): vocabulary.merge(w) for batch in batches for w in batch.column("word").to_pylist()
            if vocabulary.words(w) == [w]}
        yield pa.RecordBatch.from_arrays([pa.array([compile_words(entries)], pa.binary())], ["content"])

    return compile_all


def share_lexicon(spark: SparkSession, content: bytes) -> str:
    """Hands a lexicon file to all executors through the shared folder; its name."""
    name = f"lexicon-{hashlib.sha256(content).hexdigest()[:24]}.bin"
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/{name}")
    out = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).create(path, True)
    out.write(bytearray(content))
    out.close()
    remove_at_end(spark, path.toString())
    spark.sparkContext.addFile(path.toString())
    return name


_ENCODERS: dict[str, Encoder] = {}


def _encoder(name: str, content: str) -> Encoder:
    """The worker's encoder for a lexicon; workers serve many tasks."""
    if name not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[name] = Encoder(Vocabulary(content), Lexicon(SparkFiles.get(name)))
    return _ENCODERS[name]


def _extended(df: DataFrame, column: str, kind: str) -> str:
    return ", ".join([*(f"`{n}` {t}" for n, t in df.dtypes), f"`{column}` {kind}"])


def encode(docs: DataFrame, vocabulary_file: str, ids: str = "ids", lexicon_words: int = LEXICON_WORDS) -> DataFrame:
    """``docs`` with the token ids of ``text`` in a new last column."""
    spark = docs.sparkSession
    with open(vocabulary_file, encoding="utf-8") as file:
        content = file.read()
    # A vocabulary file is a few MB, whatever the corpus.
    sent = spark.sparkContext.broadcast(content)
    # No more than lexicon_words, to one task.
    compiled = frequent_words(docs, lexicon_words).repartition(1).mapInArrow(_compiler(sent), "content binary").first()
    name = share_lexicon(spark, bytes(compiled["content"]) if compiled else compile_words({}))
    del compiled

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(name, sent.value)
        for large in batches:
            # Small pieces keep what a worker holds small.
            for start in range(0, large.num_rows, _PIECE_ROWS):
                batch = large.slice(start, _PIECE_ROWS)
                coded = list(encoder.encode(t.as_py() for t in batch.column("text")))
                offsets = np.cumsum([0, *(len(c) // 4 for c in coded)], dtype=np.int32)
                values = pa.array(np.frombuffer(b"".join(coded), dtype=np.int32))
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.ListArray.from_arrays(pa.array(offsets), values)], [*batch.schema.names, ids])

    texts = docs.withColumn("text", F.col("text").cast("string"))
    return texts.mapInArrow(run, _extended(texts, ids, "array<int>"))


def decode(coded: DataFrame, vocabulary_file: str, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """``coded`` with the text of its ids in a new last column.

    Null ids decode to the empty text.  Tokens hold no line feed: vocabularies
    write it, as any unprintable byte, by a stand-in.
    """
    with open(vocabulary_file, encoding="utf-8") as file:
        spec = json.load(file)
    tokens = {i: t for t, i in spec["model"]["vocab"].items()} | {t["id"]: t["content"] for t in spec["added_tokens"]}
    del spec
    listed = "\n".join(tokens.get(i, "") for i in range(max(tokens) + 1))
    table = F.split(F.lit(listed), "\n")  # folded into one constant
    text = F.array_join(F.transform(F.col(ids), lambda i: F.get(table, i)), " ")
    return coded.withColumn(decoded, F.coalesce(text, F.lit("")))


def round_trip_digests(docs: DataFrame, vocabulary_file: str) -> DataFrame:
    """doc_id, number of tokens, and digests of ids and decoded text."""
    coded = encode(docs.select("doc_id", "text"), vocabulary_file).select("doc_id", "ids")
    listed = F.array_join(F.col("ids").cast("array<string>"), " ")
    return decode(coded, vocabulary_file).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(listed, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
