"""BPE encoding and decoding: backtracking encoder, offset-table decoder (operator 10).

The encoder never replays merges. An Aho-Corasick automaton over the vocabulary
finds every token that matches in a piece; from left to right the longest one is
taken, and kept only if the pair (previous token, token) is compatible: BPE run
over the two tokens' joined bytes would leave the boundary between them alone.
If no token fits, the previous one is undone and its next shorter prefix tried;
a position that failed once is never entered again, so the work is linear in the
piece. Compatibility is decided from the merge table and kept in a pair table.

Decoding looks up each id's (offset, length) in one byte block of the whole
vocabulary and gathers the bytes of a document in a single numpy step.

Defined results: a null or empty text has no ids and decodes to the empty text.
The special tokens of the vocabulary file are recognised inside a text, as the
library does. Rows keep their columns; nothing is shuffled.
"""

from __future__ import annotations

import hashlib
import json
import re
from array import array
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from tokenizers import pre_tokenizers

from activity_engine.llm.common import Cache, serve, stored

#: Characters that are surely neither white space nor line control. A single
#: space between two of them always starts a new piece, so a text may be cut there.
_SOLID = "!-~¡-ᙿᚁ-៿᠐-῿Ⰰ-⿿、-퟿\U00010000-\U0010ffff"
_CUT = re.compile(f"(?<=[{_SOLID}]) (?=[{_SOLID}])")
#: The pieces of chunks that hold only ASCII and Latin letters; the pre-tokenizer
#: of the library does the rest.
_LATIN = re.compile("[\t-\r -~À-ÖØ-öø-ɏ]*")
_LATIN_PIECE = re.compile(
    "'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-zÀ-ÖØ-öø-ɏ]+| ?[0-9]+"
    "| ?[^\t-\r A-Za-z0-9À-ÖØ-öø-ɏ]+|[\t-\r ]+(?![^\t-\r ])|[\t-\r ]+")
#: Longer chunks are encoded without being kept.
_KEEP = 64
_NEVER = 1 << 60


def _byte_alphabet() -> dict[str, int]:
    """Printable stand-in of every byte, as byte-level vocabularies write them."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class BytePairCodec:
    """Encoder and decoder of one byte-level BPE vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        vocab: dict[str, int] = spec["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        size = 1 + max([*vocab.values(), *self.special.values()])
        alphabet = _byte_alphabet()
        self.length = [0] * size
        self.born, self.left, self.right = [-1] * size, [-1] * size, [-1] * size
        self.rank: dict[tuple[int, int], int] = {}
        for rank, (a, b) in enumerate(spec["model"]["merges"]):
            x, y, token = vocab[a], vocab[b], vocab[a + b]
            self.rank[x, y] = rank
            if self.left[token] < 0:
                self.born[token], self.left[token], self.right[token] = rank, x, y
        self.automaton = ahocorasick.Automaton()
        self.shorter = [-1] * size
        raw = [b""] * size
        for token, number in vocab.items():
            raw[number] = bytes(alphabet[c] for c in token)
            self.length[number] = len(token)
            self.automaton.add_word(raw[number].decode("latin-1"), number)
            for n in range(len(token) - 1, 0, -1):
                if (prefix := vocab.get(token[:n])) is not None:
                    self.shorter[number] = prefix
                    break
        self.automaton.make_automaton()
        for token, number in self.special.items():
            raw[number] = token.encode()
        self.sizes = np.array([len(x) for x in raw], np.int64)
        self.offsets = np.concatenate([[0], np.cumsum(self.sizes)[:-1]])
        self.block = np.frombuffer(b"".join(raw), np.uint8)
        self.specials = re.compile("|".join(map(re.escape, sorted(self.special, key=len, reverse=True)))) if self.special else None
        self.pieces = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True)
        self.to_latin = str.maketrans({c: chr(b) for c, b in alphabet.items()})
        self.fits = Cache(self._compatible, 500_000)
        self.known = Cache(self._piece, 200_000)
        self.first = Cache(self._chunk)
        self.later = Cache(lambda chunk: self._chunk(" " + chunk))

    def _compatible(self, pair: tuple[int, int]) -> bool:
        """No merge crosses the boundary between the two tokens of ``pair``.

        Goes back in time over the tokens that touch the boundary, undoing the
        one made last. A crossing merge would have won if its rank comes before
        the merge that took a neighbour away; of equal ranks the left one wins.
        """
        x, y = pair
        until = _NEVER
        while True:
            if self.rank.get((x, y), _NEVER) < until:
                return False
            if self.born[x] > self.born[y]:
                until, x = self.born[x], self.right[x]
            elif self.born[y] >= 0:
                until, y = self.born[y] + 1, self.left[y]
            else:
                return True

    def _piece(self, text: str) -> tuple[int, ...]:
        """Ids of one piece, given as latin-1 characters for its bytes."""
        fits = self.fits
        greedy = [token for _, token in self.automaton.iter_long(text)]
        if all([fits[pair] for pair in zip(greedy, greedy[1:])]):
            return tuple(greedy)
        longest = [-1] * len(text)
        length = self.length
        for end, token in self.automaton.iter(text):  # ends ascend: the longest comes last
            longest[end + 1 - length[token]] = token
        out: list[int] = []
        dead = bytearray(len(text) + 1)
        at, token = 0, longest[0]
        while at < len(text):
            last = out[-1] if out else -1
            while token >= 0 and (dead[at + length[token]] or last >= 0 and not fits[last, token]):
                token = self.shorter[token]
            if token >= 0:
                out.append(token)
                at += length[token]
                token = longest[at] if at < len(text) else -1
            else:
                if not out:
                    raise ValueError("the vocabulary lacks a byte")
                dead[at] = 1
                token = out.pop()
                at -= length[token]
        return tuple(out)

    def _split(self, chunk: str) -> list[str]:
        if _LATIN.fullmatch(chunk):
            return [p.encode().decode("latin-1") for p in _LATIN_PIECE.findall(chunk)]
        return [p.translate(self.to_latin) for p, _ in self.pieces.pre_tokenize_str(chunk)]

    def _chunk(self, chunk: str) -> tuple[str, bytes]:
        ids: list[int] = []
        for piece in self._split(chunk):
            ids += self.known[piece] if len(piece) <= _KEEP else self._piece(piece)
        return ",".join(map(str, ids)), array("I", ids).tobytes()

    def encode(self, text: str | None) -> tuple[str, np.ndarray]:
        """Decimal ids joined by commas, and the ids."""
        if not text:
            return "", np.empty(0, "<u4")
        parts: list[tuple[str, bytes]] = []
        at = 0
        for found in self.specials.finditer(text) if self.specials else ():
            self._plain(text[at:found.start()], parts)
            number = self.special[found.group()]
            parts.append((str(number), np.array([number], "<u4").tobytes()))
            at = found.end()
        self._plain(text[at:] if at else text, parts)
        return ",".join([p[0] for p in parts]), np.frombuffer(b"".join([p[1] for p in parts]), "<u4")

    def _plain(self, text: str, parts: list[tuple[str, bytes]]) -> None:
        if not text:
            return
        head, *chunks = _CUT.split(text)
        parts.append(self.first[head] if len(head) <= _KEEP else self._chunk(head))
        if max(map(len, chunks), default=0) <= _KEEP:
            parts.extend(map(self.later.__getitem__, chunks))
        else:
            parts.extend(self.later[c] if len(c) <= _KEEP else self._chunk(" " + c) for c in chunks)

    def decode(self, ids: np.ndarray) -> str:
        if not len(ids):
            return ""
        sizes = self.sizes[ids]
        ends = np.cumsum(sizes)
        at = np.repeat(self.offsets[ids] - (ends - sizes), sizes) + np.arange(ends[-1])
        return self.block[at].tobytes().decode("utf-8", "replace")


@lru_cache(maxsize=2)
def codec(path: str) -> BytePairCodec:
    return BytePairCodec(path)


stored(codec.cache_clear)


def bpe_roundtrip(text: Column, vocabulary: str) -> Column:
    """Struct (n_tokens, ids_sha256, decoded_sha256) of encoding and decoding ``text``."""

    @F.arrow_udf("n_tokens long, ids_sha256 string, decoded_sha256 string")
    def roundtrip(texts: pa.Array) -> pa.Array:
        serve("bpe")
        own = codec(vocabulary)
        counts, hashes, decoded = [], [], []
        for text in texts.to_pylist():
            joined, ids = own.encode(text)
            counts.append(len(ids))
            hashes.append(hashlib.sha256(joined.encode()).hexdigest())
            decoded.append(hashlib.sha256(own.decode(ids).encode()).hexdigest())
        return pa.StructArray.from_arrays(
            [pa.array(counts, pa.int64()), pa.array(hashes, pa.string()), pa.array(decoded, pa.string())],
            ["n_tokens", "ids_sha256", "decoded_sha256"])

    return roundtrip(text)


def bpe_ids(text: Column, vocabulary: str) -> Column:
    """Ids of ``text`` as array<int>."""

    @F.arrow_udf("array<int>")
    def encode(texts: pa.Array) -> pa.Array:
        own = codec(vocabulary)
        rows = [own.encode(t)[1] for t in texts.to_pylist()]
        ends = np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int32)
        values = np.concatenate([*rows, np.empty(0, "<u4")]).astype(np.int32)
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(values))

    return encode(text)


def bpe_decode(ids: Column, vocabulary: str) -> Column:
    """Text of an array of ids (null: empty)."""

    @F.arrow_udf("string")
    def decode(lists: pa.Array) -> pa.Array:
        own = codec(vocabulary)
        return pa.array([own.decode(np.array(x or [], np.int64)) for x in lists.to_pylist()], pa.string())

    return decode(ids)


def with_bpe(docs: DataFrame, vocabulary: str, text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every row."""
    return (docs.select("doc_id", bpe_roundtrip(F.col(text_col), vocabulary).alias("_b"))
            .select("doc_id", "_b.n_tokens", "_b.ids_sha256", "_b.decoded_sha256"))
