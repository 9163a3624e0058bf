"""Token ids in ORC files: run-length integers, row indexes, Bloom filters (operator 5).

``write_tokens`` range-partitions documents by id, sorts each range and encodes it,
so every file holds one ascending id range and file names ascend with it. ORC
stores the ids with its integer run-length encoding; row-index entries every
``ROW_INDEX_STRIDE`` rows and a Bloom filter on ``doc_id`` let a lookup skip files,
stripes and row groups by metadata (``find_documents``). Stripes are independent,
so Spark reads one file with several tasks.

``read_digest`` derives each document's place in the corpus from the files alone:
a running sum inside a file, plus the sums of the files before it (one row a file).

Defined results: a null or empty text holds the end id only; rows with a null id
come first; repeated ids keep their rows, in no promised order among themselves.
"""

from __future__ import annotations

import re
import zlib
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from tokenizers import Tokenizer

END_ID = 1
ROW_INDEX_STRIDE = 1000
STRIPE_BYTES = 16 << 20
BLOOM_FPP = 0.01
_MISSES = 4096
_LIMIT = 300_000
#: Texts of ASCII and Latin letters, in which lower-casing and the vocabulary's split
#: are plain; the library alone handles the rest, and what may be a special token.
_PLAIN = re.compile("[\t-\r -~À-ÖØ-öø-ÿ]*")
_PIECE = re.compile("[a-zß-öø-ÿ]+|'(?:s|t|re|ve|m|ll|d)|[0-9]|[^\t-\r a-z0-9ß-öø-ÿ]+")
#: Pieces that stay one word of the vocabulary's split wherever they stand.
_WORD = re.compile("[a-zß-öø-ÿ]+|[0-9]|[!-/:;=-@[-`{-~]+")
_WORD_END = "</w>"


class WordEncoder:
    """Library encoder with a cache of the pieces it has encoded.

    A plain text's ids are those of its pre-tokenized pieces. The normaliser and
    the pre-tokenizer never join characters across white space, so the ids of any
    other text are those of the parts that ASCII white space separates.
    """

    def __init__(self, path: str):
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        vocab = self.library.get_vocab()
        self.ends = np.zeros(1 + max(vocab.values()), bool)
        self.ends[[i for token, i in vocab.items() if token.endswith(_WORD_END)]] = True
        self.known: dict[str, bytes] = {}
        self.last: dict[str, bytes] = {}

    @staticmethod
    def _split(text: bytes) -> list[str]:
        whole = text.decode()
        if _PLAIN.fullmatch(whole) and "<|" not in whole:
            return _PIECE.findall(whole.lower())
        return [part.decode() for part in text.split()]

    def learn(self, pieces: set[str]) -> None:
        """Make sure that ``known`` has all pieces; a full cache keeps what is asked for again."""
        if len(self.known) >= _LIMIT:
            self.last, self.known = self.known, {}
        new = []
        for piece in pieces.difference(self.known):
            if (ids := self.last.get(piece)) is None:
                new.append(piece)
            else:
                self.known[piece] = ids
        words = [p for p in new if _WORD.fullmatch(p)]
        for at in range(0, len(words), _MISSES):
            self._learn_words(words[at:at + _MISSES])
        rest = [p for p in new if p not in self.known]
        for at in range(0, len(rest), _MISSES):
            block = rest[at:at + _MISSES]
            for piece, found in zip(block, self.library.encode_batch_fast(block, add_special_tokens=False)):
                self.known[piece] = array("i", found.ids).tobytes()

    def _learn_words(self, words: list[str]) -> None:
        """Encode many words as one text; a token that ends a word ends its ids."""
        found = self.library.encode_batch_fast([" ".join(words)], add_special_tokens=False)[0]
        ids = np.array(found.ids, "<i4")
        ends = (4 * (np.flatnonzero(self.ends[ids]) + 1)).tolist()
        if len(ends) != len(words):
            return  # they are encoded one by one
        data, start = ids.tobytes(), 0
        for word, end in zip(words, ends):
            self.known[word] = data[start:end]
            start = end

    def encode(self, texts: list[bytes | None]) -> list[bytes]:
        """Little-endian 32-bit ids of each text, with the end id."""
        end = array("i", [END_ID]).tobytes()
        split = [self._split(t or b"") for t in texts]
        self.learn(set().union(*split))
        get = self.known.__getitem__
        return [b"".join(map(get, pieces)) + end for pieces in split]


@lru_cache(maxsize=2)
def encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


def token_ids(text: Column, vocabulary: str) -> Column:
    """Ids of ``text`` with the end id, as array<int>."""

    @F.arrow_udf("array<int>")
    def encode(texts: pa.Array) -> pa.Array:
        rows = encoder(vocabulary).encode(texts.cast(pa.binary()).to_pylist())
        ends = np.concatenate([[0], np.cumsum([len(r) // 4 for r in rows])]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(rows), "<i4")))

    return encode(text)


def write_tokens(docs: DataFrame, path: str, vocabulary: str, text_col: str = "text",
                 id_col: str = "doc_id") -> None:
    """Write doc_id and ids in ascending doc_id order; one ascending id range a file.

    Each row has its place in its file (``at``) and its ids' number beside them, so that
    offsets need neither an order of equal ids nor the ids.
    """
    (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("_text"))
     .repartitionByRange("doc_id").sortWithinPartitions("doc_id")
     .select("doc_id", F.monotonically_increasing_id().alias("at"), token_ids(F.col("_text"), vocabulary).alias("ids"))
     .select("doc_id", "at", F.size("ids").alias("n_tokens"), "ids")
     .write.format("orc").option("compression", "zstd")
     .option("orc.row.index.stride", ROW_INDEX_STRIDE)
     .option("orc.stripe.size", STRIPE_BYTES)
     .option("orc.bloom.filter.columns", "doc_id")
     .option("orc.bloom.filter.fpp", BLOOM_FPP)
     .save(path))


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("doc_id long, ids array<int>").orc(path)


def find_documents(spark: SparkSession, path: str, doc_ids: list[int]) -> DataFrame:
    """Rows of some ids; the predicate reaches the reader, which prunes by metadata."""
    return read_tokens(spark, path).filter(F.col("doc_id").isin(doc_ids))


def ids_crc32(ids: Column) -> Column:
    """Unsigned crc32 of the ids as little-endian unsigned 32-bit integers."""

    @F.arrow_udf("long")
    def checksum(lists: pa.Array) -> pa.Array:
        values = np.asarray(lists.values).astype("<u4")
        ends = np.asarray(lists.offsets)
        return pa.array([zlib.crc32(values[a:b]) for a, b in zip(ends[:-1], ends[1:])], pa.int64())

    return checksum(ids)


def read_digest(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document in the files."""
    stored = spark.read.schema("doc_id long, at long, n_tokens int, ids array<int>").orc(path)
    rows = stored.select("doc_id", "at", F.col("n_tokens").cast("long").alias("n_tokens"),
                         ids_crc32(F.col("ids")).alias("ids_crc32"), F.col("_metadata.file_name").alias("_file"))
    sizes = stored.select("n_tokens", F.col("_metadata.file_name").alias("_file"))
    files = sizes.groupBy("_file").agg(F.sum("n_tokens").alias("_n"))
    before = W.orderBy("_file").rowsBetween(W.unboundedPreceding, -1)
    files = files.select("_file", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    inside = W.partitionBy("_file").orderBy("at").rowsBetween(W.unboundedPreceding, -1)
    return (rows.withColumn("_inside", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0)))
            .join(files, "_file")
            .select("doc_id", (F.col("_before") + F.col("_inside")).alias("start"), "n_tokens", "ids_crc32"))
