"""Encrypted parts: whole files under a fresh key, itself wrapped with the caller's RSA public key.

File layout, integers big-endian::

    magic "TAPLENV1" | u32 header length | header (JSON) | frame*
    frame = u32 length | 12 bytes IV | ciphertext | 16 bytes tag        (AES-256-GCM)

Each file has its own key, HMAC-SHA256(data key, "part" | salt). The header names the wrapped data key and commits
to it with HMAC-SHA256(data key, "commit" | salt). A frame's associated data is SHA-256(header) | u64 frame number |
one byte that is 1 for the last frame, so frames cannot be swapped between files, reordered or cut off. AES runs in
the JVM (``aes_encrypt``); Python writes the Parquet bytes and frames them. No part is ever stored in the clear.

The parts of a folder are sealed as a set in a file of their own beside them (JSON): their number, the wrapped data key, a
salt, and HMAC-SHA256(set key, number | sum), where the set key is HMAC-SHA256(data key, "set" | salt) and the sum, modulo
2^256, is over HMAC-SHA256(set key, "member" | part number | SHA-256(header)). A missing, repeated, renumbered or foreign
part changes it. The sum is taken by the tasks, so no process sees a row for each of all parts.
"""

from __future__ import annotations

import base64
import hashlib
import hmac
import io
import json
import os
import re
import struct
import sys
import time
import uuid
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tapline.errors import ExtractionError
from tapline.operators import paths
from tapline.operators.paths import folder_name

# Executors get the helpers with the task, so they need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
cloudpickle.register_pickle_by_value(paths)

MAGIC = b"TAPLENV1"
# Name and namespace of the key in the header.
KEY_NAME, KEY_NAMESPACE = "static-id", "static-random"
FRAME_BYTES = 1 << 20
ROW_GROUP_ROWS = 100_000
MAX_READ_TASKS = 10_000

_FRAME_SCHEMA = (
    "folder string, task int, number int, seq bigint, last boolean, rows bigint, "
    "header binary, key binary, aad binary, frame binary"
)
_WRITTEN_SCHEMA = "folder string, task int, number int, rows bigint, uri string, written_millis bigint, digest binary"

# The digits that end the name of a part.
_DIGITS = re.compile(r"([0-9]{6,})\.parquet\.encrypted$")
# Numbers of 32 bits that a digest is added up in.
_LIMBS = 8


# ------------------------------------------------------------------ keys (driver)


def _pem_body(pem: str) -> bytes:
    return base64.b64decode("".join(line for line in pem.strip().splitlines() if not line.startswith("-----")))


def _rsa(spark: SparkSession, private: bool, pem: str):
    jvm = spark._jvm
    factory = jvm.java.security.KeyFactory.getInstance("RSA")
    if private:
        return factory.generatePrivate(jvm.java.security.spec.PKCS8EncodedKeySpec(_pem_body(pem)))
    return factory.generatePublic(jvm.java.security.spec.X509EncodedKeySpec(_pem_body(pem)))


def _rsa_oaep(spark: SparkSession, mode: str, key, data: bytes) -> bytes:
    cipher_class = spark._jvm.javax.crypto.Cipher
    cipher = cipher_class.getInstance("RSA/ECB/OAEPWithSHA-1AndMGF1Padding")
    cipher.init(getattr(cipher_class, mode), key)
    return bytes(cipher.doFinal(data))


def wrap_key(spark: SparkSession, public_pem: str, data_key: bytes) -> bytes:
    try:
        return _rsa_oaep(spark, "ENCRYPT_MODE", _rsa(spark, False, public_pem), data_key)
    except Exception as err:
        raise ExtractionError("encryption", f"the encryption key is not an RSA public key in PEM: {err}") from err


def unwrap_key(spark: SparkSession, private_pem: str, wrapped: bytes) -> bytes:
    try:
        return _rsa_oaep(spark, "DECRYPT_MODE", _rsa(spark, True, private_pem), wrapped)
    except Exception as err:
        raise ExtractionError("encryption", "the private key does not open these files") from err


def _derive(data_key: bytes, label: bytes, salt: bytes) -> bytes:
    return hmac.new(data_key, label + salt, hashlib.sha256).digest()


def _aad(header: bytes, seq: int, last: bool) -> bytes:
    return hashlib.sha256(header).digest() + struct.pack(">QB", seq, last)


def seal_uri(folder: str, prefix: str) -> str:
    """The seal of the parts of a folder; Spark's readers pass over names like this."""
    return f"{folder}/_{prefix}parts.seal"


def _member(set_key: bytes, number: int, digest: bytes) -> bytes:
    return hmac.new(set_key, b"member" + struct.pack(">Q", number) + digest, hashlib.sha256).digest()


def _set_mac(set_key: bytes, parts: int, total: int) -> bytes:
    return hmac.new(set_key, struct.pack(">Q", parts) + (total % (1 << 256)).to_bytes(32, "big"), hashlib.sha256).digest()


@dataclass(frozen=True)
class Sealing:
    """What seals the parts of one run."""

    data_key: bytes = field(repr=False)
    wrapped: bytes

    def seal(self, digests: Iterable[bytes]) -> str:
        """The text of the seal of a folder, from the header digests of its parts in order."""
        salt = os.urandom(16)
        set_key, total, parts = _derive(self.data_key, b"set", salt), 0, 0
        for digest in digests:
            total += int.from_bytes(_member(set_key, parts, digest), "big")
            parts += 1
        told = {"wrapped_key": self.wrapped, "salt": salt, "seal": _set_mac(set_key, parts, total)}
        return json.dumps({"parts": parts, **{k: base64.b64encode(v).decode() for k, v in told.items()}})


def _file_system(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri.replace("s3a://", "s3://", 1))


# ------------------------------------------------------------------ writing (executors)


class _Part(io.RawIOBase):
    """An append-only file whose bytes leave as frames of a fixed size."""

    def __init__(self, folder: str, task: int, number: int, wrapped: bytes, data_key: bytes, schema_json: str):
        super().__init__()
        salt = os.urandom(16)
        encoded = {
            "wrapped_key": wrapped, "salt": salt, "commitment": _derive(data_key, b"commit", salt),
        }
        self._header = json.dumps({
            "key_wrap": "RSA-OAEP-SHA1-MGF1", "cipher": "AES-256-GCM", "key_name": KEY_NAME,
            "key_namespace": KEY_NAMESPACE, "frame_bytes": FRAME_BYTES, "schema": schema_json,
            **{k: base64.b64encode(v).decode() for k, v in encoded.items()},
        }).encode()
        self._key = _derive(data_key, b"part", salt)
        self._place = (folder, task, number)
        self._pending = bytearray()
        self._written = 0
        self._seq = 0
        self.rows = 0

    def writable(self) -> bool:
        return True

    def tell(self) -> int:
        return self._written

    def write(self, data) -> int:
        view = memoryview(data)
        self._pending += view
        self._written += view.nbytes
        return view.nbytes

    def _frame(self, data: bytes, last: bool) -> dict:
        folder, task, number = self._place
        row = {
            "folder": folder, "task": task, "number": number, "seq": self._seq, "last": last,
            "rows": self.rows, "header": self._header if self._seq == 0 else None,
            "key": self._key, "aad": _aad(self._header, self._seq, last), "frame": data,
        }
        self._seq += 1
        return row

    def full_frames(self) -> Iterator[dict]:
        while len(self._pending) > FRAME_BYTES:
            data = bytes(self._pending[:FRAME_BYTES])
            del self._pending[:FRAME_BYTES]
            yield self._frame(data, False)

    def last_frame(self) -> dict:
        return self._frame(bytes(self._pending), True)


def _frames_schema() -> pa.Schema:
    return pa.schema([
        ("folder", pa.string()), ("task", pa.int32()), ("number", pa.int32()), ("seq", pa.int64()),
        ("last", pa.bool_()), ("rows", pa.int64()), ("header", pa.binary()), ("key", pa.binary()),
        ("aad", pa.binary()), ("frame", pa.binary()),
    ])


def _encoder(dir_columns: tuple[str, ...], rows_per_part: int, wrapped: bytes, data_key: bytes, schema_json: str,
             arrow_schema: pa.Schema, keep_empty: bool):
    """mapInArrow function: rows to frames of Parquet files, a new file every ``rows_per_part`` rows of a folder."""

    def runs(batch: pa.RecordBatch) -> Iterator[tuple[str, pa.Table]]:
        table = pa.Table.from_batches([batch])
        data = table.drop_columns(list(dir_columns)) if dir_columns else table
        if not dir_columns:
            yield "", data
            return
        if not len(table):
            return
        change = np.zeros(len(table) - 1, bool)
        for c in dir_columns:
            text = pc.fill_null(table.column(c).cast(pa.string()), "")
            change |= pc.not_equal(text[1:], text[:-1]).to_numpy()
        cuts = [0, *(np.flatnonzero(change) + 1).tolist(), len(table)]
        for start, stop in zip(cuts, cuts[1:]):
            values = tuple(table.column(c)[start].as_py() for c in dir_columns)
            yield folder_name(dir_columns, values), data.slice(start, stop - start)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        part = writer = None
        buffered: list[pa.Table] = []
        folder, number = None, 0

        def batch_of(rows: list[dict]) -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist(rows, schema=_frames_schema())

        def flush() -> None:
            if buffered:
                writer.write_table(pa.concat_tables(buffered), row_group_size=ROW_GROUP_ROWS)
                buffered.clear()

        def begin() -> None:
            nonlocal part, writer
            part = _Part(folder, task, number, wrapped, data_key, schema_json)
            writer = pq.ParquetWriter(pa.PythonFile(part, mode="w"), arrow_schema, compression="snappy", version="1.0")

        def finish() -> Iterator[pa.RecordBatch]:
            nonlocal part, writer
            flush()
            writer.close()
            for row in part.full_frames():
                yield batch_of([row])
            yield batch_of([part.last_frame()])
            part = writer = None

        for batch in batches:
            for name, rows in runs(batch):
                if part is not None and name != folder:
                    yield from finish()
                if name != folder:
                    folder, number = name, 0
                at = 0
                while at < rows.num_rows:
                    if part is None:
                        begin()
                    take = min(rows.num_rows - at, rows_per_part - part.rows)
                    buffered.append(rows.slice(at, take).cast(arrow_schema))
                    part.rows += take
                    at += take
                    if sum(t.num_rows for t in buffered) >= ROW_GROUP_ROWS:
                        flush()
                        for row in part.full_frames():
                            yield batch_of([row])
                    if part.rows == rows_per_part:
                        yield from finish()
                        number += 1
        if part is not None:
            yield from finish()
        elif folder is None and keep_empty and task == 0:
            folder = ""
            begin()
            yield from finish()

    return encode


def _file_writer(staging: str):
    """mapInArrow function: sealed frames to files, one row back per file. Names are unique per attempt."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = _file_system(staging)
        fs.create_dir(root, recursive=True)
        out = path = None
        for batch in batches:
            for row in batch.to_pylist():
                if row["seq"] == 0:
                    digest = hashlib.sha256(row["header"]).digest()
                    path = f"{root}/{uuid.uuid4().hex}"
                    out = fs.open_output_stream(path)
                    out.write(MAGIC + struct.pack(">I", len(row["header"])) + row["header"])
                out.write(struct.pack(">I", len(row["frame"])) + row["frame"])
                if row["last"]:
                    out.close()
                    uri = f"{staging}/{path.rsplit('/', 1)[-1]}"
                    yield pa.RecordBatch.from_pylist([{
                        "folder": row["folder"], "task": row["task"], "number": row["number"],
                        "rows": row["rows"], "uri": uri, "written_millis": int(time.time() * 1000), "digest": digest,
                    }], schema=pa.schema([
                        ("folder", pa.string()), ("task", pa.int32()), ("number", pa.int32()), ("rows", pa.int64()),
                        ("uri", pa.string()), ("written_millis", pa.int64()), ("digest", pa.binary()),
                    ]))

    return write


def new_sealing(spark: SparkSession, public_pem: str) -> Sealing:
    data_key = os.urandom(32)
    return Sealing(data_key, wrap_key(spark, public_pem, data_key))


def write_encrypted(df: DataFrame, options, staging: str, sealing: Sealing) -> Iterator[tuple]:
    """Encode, seal and store the rows in one stage; yields folder, task, number, rows, uri, time, header digest per file."""
    wrapped, data_key = sealing.wrapped, sealing.data_key
    if options.dir_columns and not options.order_by:
        # Rows of a folder side by side: a task writes one run of files for each of its folders.
        df = df.sortWithinPartitions(*[F.col("`" + c.replace("`", "``") + "`") for c in options.dir_columns])
    data = df.drop(*options.dir_columns)
    arrow_schema = data.limit(0).toArrow().schema
    encode = _encoder(options.dir_columns, options.rows_per_part, wrapped, data_key, data.schema.json(),
                      arrow_schema, not options.dir_columns)
    sealed = df.mapInArrow(encode, _FRAME_SCHEMA).select(
        "folder", "task", "number", "seq", "last", "rows", "header",
        F.expr("aes_encrypt(frame, key, 'GCM', 'DEFAULT', '', aad)").alias("frame"),
    )
    for row in sealed.mapInArrow(_file_writer(staging), _WRITTEN_SCHEMA).collect():
        yield tuple(row)


# ------------------------------------------------------------------ reading back


def _read_header(stream) -> tuple[bytes, dict]:
    if stream.read(len(MAGIC)) != MAGIC:
        raise ValueError("not an encrypted part")
    header = stream.read(struct.unpack(">I", stream.read(4))[0])
    return header, json.loads(header)


def _header_reader(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for uri in batch.column("uri").to_pylist():
            fs, path = _file_system(uri)
            with fs.open_input_stream(path) as stream:
                _, header = _read_header(stream)
            yield pa.RecordBatch.from_pydict({"wrapped": [header["wrapped_key"]], "schema": [header["schema"]]})


def _frame_reader(keys: dict[str, bytes]):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri in batch.column("uri").to_pylist():
                fs, path = _file_system(uri)
                with fs.open_input_stream(path) as stream:
                    header, fields = _read_header(stream)
                    data_key, salt = keys[fields["wrapped_key"]], base64.b64decode(fields["salt"])
                    if not hmac.compare_digest(_derive(data_key, b"commit", salt),
                                               base64.b64decode(fields["commitment"])):
                        raise ValueError(f"{uri} was not sealed with this key")
                    key, seq = _derive(data_key, b"part", salt), 0
                    length = stream.read(4)
                    while length:
                        size = struct.unpack(">I", length)[0]
                        frame = stream.read(size)
                        if len(frame) != size:
                            raise ValueError(f"{uri} is cut off in a frame")
                        length = stream.read(4)
                        yield pa.RecordBatch.from_pydict({
                            "last": [not length], "key": [key], "frame": [frame],
                            "aad": [_aad(header, seq, not length)],
                        })
                        seq += 1
                    if not seq:
                        raise ValueError(f"{uri} is cut off: it has no frame")

    return read


def _decoder(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    pending = io.BytesIO()
    for batch in batches:
        for row in batch.to_pylist():
            pending.write(row["frame"])
            if row["last"]:
                pending.seek(0)
                yield from pq.ParquetFile(pending).iter_batches()
                pending = io.BytesIO()
    if pending.tell():
        raise ValueError("a part is cut off: it has no last frame")


def _member_reader(seals: dict[tuple[str, str], tuple[str, bytes]]):
    """Sums of what the parts at hand add to the seals of their folders."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri in batch.column("uri").to_pylist():
                fs, path = _file_system(uri)
                with fs.open_input_stream(path) as stream:
                    header, fields = _read_header(stream)
                folder, prefix, number = next(p for p in _places(uri) if p[:2] in seals)
                wrapped, set_key = seals[folder, prefix]
                if fields["wrapped_key"] != wrapped:
                    raise ValueError(f"{uri} is a part of another run")
                limbs = struct.unpack(f">{_LIMBS}I", _member(set_key, number, hashlib.sha256(header).digest()))
                yield pa.RecordBatch.from_pydict({
                    "folder": [folder], "prefix": [prefix], "schema": [fields["schema"]],
                    **{f"limb{i}": pa.array([n], pa.int64()) for i, n in enumerate(limbs)}})

    return read


def _places(uri: str) -> list[tuple[str, str, int]]:
    """Folder, prefix and number that a name may stand for: digits before the last six can belong to either."""
    folder, _, name = uri.rpartition("/")
    found = _DIGITS.search(name)
    if not found:
        raise ExtractionError("encryption", f"{uri} is not named like an encrypted part")
    digits, before = found[1], name[:found.start()]
    splits = [i for i in range(len(digits) - 6, -1, -1) if i == len(digits) - 6 or digits[i] != "0"]
    return [(folder, before + digits[:i], int(digits[i:])) for i in splits]


def _checked_sets(spark: SparkSession, files: DataFrame, uris: list[str], private_pem: str) -> tuple[set[str], dict[str, bytes]]:
    """Schemas and data keys of the parts, which must be all the parts of their folders, each once."""
    seals, told = {}, {}
    for uri in uris:
        places = [p[:2] for p in _places(uri)]
        if any(p in told for p in places):
            continue
        for folder, prefix in places:
            fs, path = _file_system(seal_uri(folder, prefix))
            if fs.get_file_info(path).type == pafs.FileType.File:
                with fs.open_input_stream(path) as stream:
                    seal = json.loads(stream.read())
                told[folder, prefix] = {k: v if k == "parts" else base64.b64decode(v) for k, v in seal.items()}
                break
        else:
            raise ExtractionError("encryption", f"the parts of {places[0][0]} have no seal: read them with partial=True")
    keys = {w: unwrap_key(spark, private_pem, w) for w in {t["wrapped_key"] for t in told.values()}}
    for place, seal in told.items():
        wrapped = seal["wrapped_key"]
        seals[place] = base64.b64encode(wrapped).decode(), _derive(keys[wrapped], b"set", seal["salt"])
    limbs = [f"limb{i}" for i in range(_LIMBS)]
    members = files.mapInArrow(_member_reader(seals), "folder string, prefix string, schema string, " + ", ".join(
        f"{n} bigint" for n in limbs))
    sums = members.groupBy("folder", "prefix").agg(
        F.count("*").alias("n"), F.collect_set("schema").alias("schemas"), *(F.sum(n).alias(n) for n in limbs)).collect()
    for row in sums:
        seal, (_, set_key) = told[row["folder"], row["prefix"]], seals[row["folder"], row["prefix"]]
        total = sum(row[n] << 32 * (_LIMBS - 1 - i) for i, n in enumerate(limbs))
        if row["n"] != seal["parts"] or not hmac.compare_digest(_set_mac(set_key, row["n"], total), seal["seal"]):
            raise ExtractionError(
                "encryption", f"the {row['n']} parts given of {row['folder']} are not the {seal['parts']} that were written")
    return {s for row in sums for s in row["schemas"]}, {base64.b64encode(w).decode(): k for w, k in keys.items()}


def read_encrypted(spark: SparkSession, uris: list[str], private_pem: str, partial: bool = False) -> DataFrame:
    """Rows of encrypted parts, whole files per task. A frame that was changed, moved or cut off fails the read.

    The parts must be all those of their folders, each once and under its own name; ``partial`` takes any of them.
    """
    tasks = max(1, min(len(uris), MAX_READ_TASKS))
    files = spark.createDataFrame([(i % tasks, u) for i, u in enumerate(uris)], "task int, uri string").repartitionById(
        tasks, F.col("task")
    ).select("uri")
    if partial:
        heads = files.mapInArrow(_header_reader, "wrapped string, schema string").distinct().collect()
        schemas = {r["schema"] for r in heads}
        keys = {r["wrapped"]: unwrap_key(spark, private_pem, base64.b64decode(r["wrapped"])) for r in heads}
    else:
        schemas, keys = _checked_sets(spark, files, uris, private_pem)
    if len(schemas) != 1:
        raise ExtractionError("encryption", f"the parts have {len(schemas)} different schemas")
    opened = files.mapInArrow(_frame_reader(keys), "last boolean, key binary, frame binary, aad binary").select(
        "last", F.expr("aes_decrypt(frame, key, 'GCM', 'DEFAULT', aad)").alias("frame")
    )
    return opened.mapInArrow(_decoder, T.StructType.fromJson(json.loads(schemas.pop())))
