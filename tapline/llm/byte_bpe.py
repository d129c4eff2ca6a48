"""Byte-level BPE over a public rank file, run by a sentencepiece BPE model that is serialised from the vocabulary.

Each byte is mapped to a printable character, each token to the string of its mapped bytes, and the token's score is its
negative rank: the model then merges the pair of lowest rank first, leftmost on ties, as byte-level BPE does. No
normalisation takes place. A pre-token that is itself a token is that token. Ids are the ranks; decoding maps pieces back.

Nulls and empty texts have no ids. Texts of any length are cut into pre-tokens as they stream by. Repeated rows are coded
alike, an empty table gives an empty one, and an input column with the name of a result column is replaced.
"""

from __future__ import annotations

import base64
import itertools
import re
import struct
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapline.llm.common import blocks, send_package, strings_of, table, with_columns

# Pre-tokens kept with their ids in each Python worker, and pre-tokens of a long text handled at once.
REMEMBERED, AT_ONCE = 150_000, 1 << 18
# Bytes of text whose ids and decoded bytes are held by a worker before they go back to Spark.
TOGETHER = 1 << 18
_CODED = pa.struct([("ids", pa.binary()), ("decoded", pa.binary())])


def byte_characters() -> list[str]:
    """A printable character for each byte: itself if printable in Latin-1, else the next one from U+0100 on."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    spare = itertools.count(0x100)
    return [chr(b) if b in printable else chr(next(spare)) for b in range(256)]


def read_ranks(path: str) -> list[bytes]:
    """Tokens of a rank file (base64 and rank per line) in order of rank."""
    with open(path, "rb") as lines:
        ranks = {int(rank): base64.b64decode(token) for token, rank in map(bytes.split, lines)}
    if sorted(ranks) != list(range(len(ranks))):
        raise ValueError(f"the ranks of {path} have gaps")
    return [ranks[i] for i in range(len(ranks))]


def _field(number: int, payload: bytes) -> bytes:
    """A length-delimited protocol buffer field."""
    size, head = len(payload), bytearray([number << 3 | 2])
    while size >= 0x80:
        head.append(size & 0x7F | 0x80)
        size >>= 7
    return bytes(head) + bytes([size]) + payload


def serialise(tokens: list[bytes]) -> bytes:
    """A sentencepiece model whose piece i is token i; one unknown piece follows, which byte input never needs."""
    letters = byte_characters()
    out = bytearray()
    for rank, token in enumerate(tokens):
        piece = "".join(letters[b] for b in token).encode()
        out += _field(1, _field(1, piece) + b"\x15" + struct.pack("<f", -rank))
    out += _field(1, _field(1, b"<unk>") + b"\x15" + struct.pack("<f", 0) + b"\x18\x02")
    # trainer: model type 2 is BPE; normaliser: identity, no dummy prefix, spaces kept and not escaped.
    out += _field(2, b"\x18\x02")
    out += _field(3, _field(1, b"identity") + b"\x18\x00\x20\x00\x28\x00")
    return bytes(out)


def narrow_pattern(pattern: str) -> re.Pattern | None:
    """The pattern for texts of Latin-1 characters, with the classes spelt out; None if it has other escapes.

    The standard matcher takes half the time of the one that knows all of Unicode, and finds the same there.
    """
    import regex

    def members(kind: str) -> str:
        return "".join(re.escape(chr(i)) for i in range(256) if regex.match(kind, chr(i)))

    inside = {kind: members(kind) for kind in (r"\p{L}", r"\p{N}", r"\s")}
    sets = re.sub(r"\[[^]]*\]", lambda m: re.sub(r"\\p\{[LN]\}|\\s", lambda k: inside[k[0]], m[0]), pattern)
    if "\\S" in "".join(re.findall(r"\[[^]]*\]", pattern)):
        return None
    plain = sets.replace(r"\S", f"[^{inside[r'\s']}]")
    for kind, all_of in inside.items():
        plain = plain.replace(kind, f"[{all_of}]")
    return None if re.search(r"\\[pPwWdDbB]|\[\[|&&", plain) else re.compile(plain)


class Codec:
    """Encoder and decoder of one vocabulary; `load` keeps one per Python worker."""

    def __init__(self, path: str, pattern: str):
        import regex
        import sentencepiece

        tokens = read_ranks(path)
        self.find, self.find_latin = regex.compile(pattern), narrow_pattern(pattern)
        self.model = sentencepiece.SentencePieceProcessor(model_proto=serialise(tokens))
        self.letters = dict(enumerate(byte_characters()))
        self.whole = {t.decode(): struct.pack("<I", i) for i, t in enumerate(tokens) if _is_text(t)}
        self.known = dict(self.whole)

    def _matcher(self, text: str):
        if self.find_latin is not None:
            try:
                text.encode("latin-1")
            except UnicodeEncodeError:
                return self.find
            return self.find_latin
        return self.find

    def _mapped(self, word: str) -> str:
        if word.isascii() and word.isprintable():
            return word.replace(" ", self.letters[32])
        return word.encode().decode("latin-1").translate(self.letters)

    def _learn(self, words: Iterable[str]) -> None:
        """See to it that the ids of these pre-tokens are known."""
        words = set(words)
        new = list(words.difference(self.known))
        if len(self.known) + len(new) > REMEMBERED:
            self.known = dict(self.whole)
            new = list(words.difference(self.known))
        coded = self.model.encode([self._mapped(w) for w in new], out_type=int, num_threads=1) if new else []
        for word, ids in zip(new, coded, strict=True):
            self.known[word] = struct.pack(f"<{len(ids)}I", *ids)

    def _stream(self, text: str) -> bytes:
        """The ids of a long text, a bounded number of pre-tokens at a time."""
        out, matches = [], (m.group() for m in self._matcher(text).finditer(text))
        while words := list(itertools.islice(matches, AT_ONCE)):
            self._learn(words)
            out.append(b"".join(map(self.known.__getitem__, words)))
        return b"".join(out)

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, each id as four little-endian bytes."""
        if any(len(text) > AT_ONCE for text in texts):
            return [self._stream(text) for text in texts]
        split = [self._matcher(text).findall(text) for text in texts]
        self._learn(itertools.chain.from_iterable(split))
        return [b"".join(map(self.known.__getitem__, words)) for words in split]


class Decoder:
    """The inverse mapping alone, from pieces of mapped bytes back to bytes."""

    def __init__(self, path: str):
        letters = byte_characters()
        back = {letter: byte for byte, letter in enumerate(letters)}
        pieces = ("".join(map(letters.__getitem__, token)) for token in read_ranks(path))
        self.bytes_by_id = [bytes(map(back.__getitem__, piece)) for piece in pieces]

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.bytes_by_id.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def _is_text(token: bytes) -> bool:
    try:
        token.decode()
    except UnicodeDecodeError:
        return False
    return True


@lru_cache(maxsize=4)
def load(path: str, pattern: str) -> Codec:
    return Codec(path, pattern)


@lru_cache(maxsize=4)
def load_decoder(path: str) -> Decoder:
    return Decoder(path)


def encode(docs: DataFrame, path: str, pattern: str, text_col: str = "text", ids_col: str = "ids") -> DataFrame:
    """Add the ids of each whole text as packed little-endian unsigned 32-bit integers (`ids_array` unpacks them)."""
    send_package(docs)

    @F.arrow_udf("binary")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        codec = load(path, pattern)
        for column in batches:
            done = []
            for start, stop in blocks(column):
                done += codec.encode(strings_of(column[start:stop]))
            yield pa.array(done, pa.binary())

    return with_columns(docs, {ids_col: run(F.col(text_col))})


def decode(coded: DataFrame, path: str, ids_col: str = "ids", bytes_col: str = "decoded") -> DataFrame:
    """Add the bytes that packed ids stand for; null ids are empty."""
    send_package(coded)

    @F.arrow_udf("binary")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        codec = load_decoder(path)
        for column in batches:
            yield pa.array([codec.decode(ids.as_buffer() if ids.is_valid else b"") for ids in column], pa.binary())

    return with_columns(coded, {bytes_col: run(F.col(ids_col))})


def transcoded(texts: pa.Array, codec: Codec, back: Decoder) -> Iterator[pa.Array]:
    """(ids, decoded) of each text, some texts at a time."""
    for start, stop in blocks(texts, TOGETHER):
        ids = codec.encode(strings_of(texts[start:stop]))
        yield pa.StructArray.from_arrays(
            [pa.array(ids, pa.binary()), pa.array(map(back.decode, ids), pa.binary())], fields=list(_CODED))


def transcode(docs: DataFrame, path: str, pattern: str, text_col: str = "text", ids_col: str = "ids",
              bytes_col: str = "decoded") -> DataFrame:
    """`encode` and `decode` in one step: the ids of each whole text, and what they decode to, by one worker of a task."""
    send_package(docs)

    @F.arrow_udf("struct<ids: binary, decoded: binary>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        codec, back = load(path, pattern), load_decoder(path)
        for column in batches:
            yield from transcoded(column, codec, back)

    both = with_columns(docs, {"_tl_coded": run(F.col(text_col))})
    coded = F.col("_tl_coded")
    return with_columns(both, {ids_col: coded["ids"], bytes_col: coded["decoded"]}).drop("_tl_coded")


def ids_array(ids_col: str = "ids"):
    """Packed ids as an array of long."""

    @F.arrow_udf("array<bigint>")
    def run(column: pa.Array) -> pa.Array:
        return pa.array([np.frombuffer(x.as_buffer(), "<u4").astype(np.int64) if x.is_valid else None for x in column],
                        pa.list_(pa.int64()))

    return run(F.col(ids_col))


def digests(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, and digests of the ids and of the decoded bytes."""
    coded = transcode(docs.select("doc_id", "text"), path, pattern)
    return coded.select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return digests(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"),
                   public_tokenizers.PATTERN)
