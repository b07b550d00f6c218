"""Token ids as length-delimited binary records with masked checksums and a separate offset index.

A shard is a range of ids, sorted. Its `.rec` file holds one record per document:

    length        u64      of the payload
    its checksum  u32      masked CRC-32C of the eight length bytes
    payload                document id i64, flags u16 (1: the id is NULL), width u16, then the token
                           ids as little-endian unsigned numbers of `width` bytes
    its checksum  u32      masked CRC-32C of the payload

Its `.idx` file holds the offset of each record and the end of the last one as u64, so a reader can
fetch any record alone: `shuffled` reads all of them in a random order that is the same for a seed.

Files are named by shard and attempt; only the names that reach the written manifest count, so a
lost or repeated task leaves nothing that a reader sees. Width is 2 where the vocabulary fits.

Words are encoded by the tokenizer once per task and looked up after that. This is sound only for
tokenizers that split words as `splits_by_words` tests: no token crosses ASCII white space, and
letters, digits and other marks never share one. Words of lower-case Latin letters alone, which normalizing and
splitting would leave as they are, go to the tokenizer's model directly.

Edge cases: NULL and empty texts are records with the end id alone. NULL ids come first. Repeated
rows are records of their own. An empty table gives no shard. Other columns are never looked at.
"""

from __future__ import annotations

import json
import os
import struct
import uuid
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderloom.llm.checksums import Crc32c
from orderloom.llm.common import open_store, staged
from orderloom.session import new_folder

END_ID = 1
HEAD = "<qHH"
HEAD_BYTES = struct.calcsize(HEAD)
SHARD_BYTES = 64 << 20
SHARDS_PER_TASK = 16
MOST_CACHED = 1_000_000
TEXTS_AT_ONCE = 4096
READ_BYTES = 8 << 20
MANIFEST = "shard int, folder string, name string, records long, tokens long, bytes long"
TOKENS = "doc_id long, start long, n_tokens long, ids_crc32 long"


# Fixed value: the split pattern of the tokenizers that may be cut at words.
WORD_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def splits_by_words(spec: str) -> bool:
    """Whether the tokenizer lower-cases, keeps what WORD_SPLIT matches apart, and drops all else."""
    parts = json.loads(spec).get("pre_tokenizer") or {}
    first = (parts.get("pretokenizers") or [parts])[0]
    kept = first.get("behavior") == "Removed" and first.get("invert")
    steps = (json.loads(spec).get("normalizer") or {}).get("normalizers") or []
    lower = any(step.get("type") == "Lowercase" for step in steps)
    return first.get("pattern") == {"Regex": WORD_SPLIT} and bool(kept) and lower


# Letters that composing and lower-casing leave alone, and marks at the end of a word.
PLAIN_LETTERS = "abcdefghijklmnopqrstuvwxyzßàáâãäåæçèéêëìíîïðñòóôõöøùúûüýþÿ"
CLOSING_MARKS = "".join(c for c in map(chr, range(33, 127)) if not c.isalnum())


def byte_letters(spec: str) -> dict[int, str] | None:
    """PLAIN_LETTERS as the model takes them; None where words of them must go through the whole tokenizer."""
    from tokenizers import pre_tokenizers

    parts = json.loads(spec)
    steps = (parts.get("pre_tokenizer") or {}).get("pretokenizers") or []
    last = {k: v for k, v in steps[-1].items() if k != "trim_offsets"} if len(steps) == 2 else None
    kinds = {s.get("type") for s in (parts.get("normalizer") or {}).get("normalizers") or []}
    added = any("<|" not in t["content"] for t in parts.get("added_tokens") or [])
    cut = parts.get("truncation") or parts.get("padding") or parts.get("post_processor")
    if last != {"type": "ByteLevel", "add_prefix_space": False, "use_regex": False} or added or cut:
        return None
    # What is replaced must be white space, of which words have none.
    replaced = [s.get("pattern") for s in parts["normalizer"]["normalizers"] if s.get("type") == "Replace"]
    if not kinds <= {"NFC", "Replace", "Lowercase"} or any(p != {"Regex": r"\s+"} for p in replaced):
        return None
    split = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
    return {ord(c): split.pre_tokenize_str(c)[0][0] for c in PLAIN_LETTERS}


class Encoder:
    """Encodes texts; a word that was met before is not encoded again."""

    def __init__(self, spec: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_str(spec)
        self.width = 2 if self._tokenizer.get_vocab_size() <= 1 << 16 else 4
        self._by_word = splits_by_words(spec)
        self._letters = byte_letters(spec) if self._by_word else None
        self._model = self._tokenizer.model
        # The empty word stands where a text begins or ends in white space.
        self._known: dict[bytes, bytes] = {b"": b""}

    def _packed(self, texts: list[str]) -> list[bytes]:
        code = "H" if self.width == 2 else "I"
        found = self._tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [array(code, e.ids).tobytes() for e in found]

    def encode(self, texts: pa.Array) -> list[bytes]:
        """The ids of each text, packed; a NULL text has none."""
        texts = texts.fill_null("")
        if not self._by_word:
            return self._packed(texts.to_pylist())
        if len(self._known) > MOST_CACHED:
            self._known = {b"": b""}
        lists = pc.ascii_split_whitespace(texts)
        words = pc.dictionary_encode(lists.flatten())
        distinct = _lowered(words.dictionary).cast(pa.binary()).to_pylist()
        known = self._known
        found = list(map(known.get, distinct))
        if None in found:
            self._learn({w for w, ids in zip(distinct, found) if ids is None})
            found = list(map(known.__getitem__, distinct))
        each = pa.array(found, pa.binary()).take(words.indices)
        return pc.binary_join(pa.ListArray.from_arrays(lists.offsets, each), b"").to_pylist()

    def _learn(self, words: set[bytes]) -> None:
        """Encode the new words, those that differ in closing marks only once: after a letter or digit of Latin
        script marks are a token run of their own."""
        known = self._known
        plain, marked = {}, []
        for word in words:
            text = word.decode()
            core = text.rstrip(CLOSING_MARKS)
            if len(core) == len(text) or not core or not _closed(core) or "<|" in text:
                plain[word] = text
                continue
            head, marks = core.encode(), text[len(core) :].encode()
            marked.append((word, head, marks))
            plain[head], plain[marks] = core, text[len(core) :]
        new = [(w, t) for w, t in plain.items() if w not in known]
        if self._letters is not None:
            letters, code = self._letters, "H" if self.width == 2 else "I"
            rest, tokenize = [], self._model.tokenize
            for word, text in new:
                if text.strip(PLAIN_LETTERS):
                    rest.append((word, text))
                else:
                    text = text if text.isascii() else text.translate(letters)
                    known[word] = array(code, [t.id for t in tokenize(text)]).tobytes()
            new = rest
        known.update(zip([w for w, _ in new], self._packed([t for _, t in new])))
        known.update([(w, known[head] + known[marks]) for w, head, marks in marked])


def _closed(core: str) -> bool:
    """Whether it ends, lower-cased too, in a letter or digit that all Unicode versions know, up to U+024F."""
    return core[-1] < "\u0250" and core[-1].lower().isalnum()


def _lowered(words: pa.Array) -> pa.Array:
    """Words of ASCII lower-cased, as the tokenizer would; what may be a special token is not."""
    lower = pc.and_not(pc.string_is_ascii(words), pc.match_substring(words, "<|"))
    return pc.if_else(lower, pc.ascii_lower(words), words)


def _table(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary()}
    names, types = zip(*(part.split() for part in schema.split(", ")))
    columns = list(zip(*rows)) if rows else [()] * len(names)
    arrays = [pa.array(c, kinds[t]) for c, t in zip(columns, types)]
    return pa.RecordBatch.from_arrays(arrays, list(names))


def write_records(
    docs: DataFrame,
    tokenizer_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    folder: str | None = None,
    shard_bytes: int = SHARD_BYTES,
) -> DataFrame:
    """Write the files in ascending id order; returns the manifest, a row per shard.

    A shard takes about `shard_bytes` of text; fuller shards also encode fewer words twice.
    """
    spark = docs.sparkSession
    folder = folder or new_folder(spark, "records")
    with open(tokenizer_path, encoding="utf-8") as f:
        spec = spark.sparkContext.broadcast(f.read())

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, crc = Encoder(spec.value), Crc32c()
        shard = TaskContext.get().partitionId()
        name = f"{shard:07d}-{uuid.uuid4().hex}"
        out, offsets, tokens = None, [0], 0
        for batch in batches:
            for low in range(0, batch.num_rows, TEXTS_AT_ONCE):
                part = batch.slice(low, TEXTS_AT_ONCE)
                ids = encoder.encode(part.column(1))
                end = END_ID.to_bytes(encoder.width, "little")
                payloads = [
                    struct.pack(HEAD, doc or 0, doc is None, encoder.width) + own + end
                    for doc, own in zip(part.column(0).to_pylist(), ids)
                ]
                lengths = [len(p).to_bytes(8, "little") for p in payloads]
                sums, checks = crc.masked(lengths), crc.masked(payloads)
                if out is None:
                    store, root = open_store(folder)
                    store.create_dir(root, recursive=True)
                    out = store.open_output_stream(f"{root}/{name}.rec")
                for length, a, payload, b in zip(lengths, sums.tolist(), payloads, checks.tolist()):
                    out.write(length + a.to_bytes(4, "little"))
                    out.write(payload)
                    out.write(b.to_bytes(4, "little"))
                    offsets.append(offsets[-1] + len(payload) + 16)
                    tokens += (len(payload) - HEAD_BYTES) // encoder.width
        if out is not None:
            out.close()
            with store.open_output_stream(f"{root}/{name}.idx") as index:
                index.write(np.array(offsets, dtype="<u8").tobytes())
            row = (shard, folder, name, len(offsets) - 1, tokens, offsets[-1])
            yield _table([row], MANIFEST)

    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    ranged = own.withColumn("copy", F.xxhash64("text"))
    size = docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    shards = max(spark.sparkContext.defaultParallelism, -(-size // shard_bytes))
    ranged = ranged.repartitionByRange(shards, "doc_id", "copy")
    ranged = ranged.sortWithinPartitions("doc_id", "copy")
    return staged(ranged.select("doc_id", "text").mapInArrow(write, MANIFEST), "manifest")


def _checked(crc: Crc32c, framed: list[bytes]) -> list[bytes]:
    """The payloads of framed records; a wrong length or checksum raises."""
    payloads = [r[12:-4] for r in framed]
    sums = [(r[8:12], r[-4:]) for r in framed]
    lengths = crc.masked([r[:8] for r in framed]).astype("<u4")
    checks = crc.masked(payloads).astype("<u4")
    for record, payload, (a, b), x, y in zip(framed, payloads, sums, lengths, checks):
        whole = int.from_bytes(record[:8], "little") == len(payload)
        if not whole or a != x.tobytes() or b != y.tobytes():
            raise ValueError("damaged record")
    return payloads


def _ids(payload: bytes) -> tuple[int | None, np.ndarray]:
    doc, is_null, width = struct.unpack_from(HEAD, payload)
    return None if is_null else doc, np.frombuffer(payload, f"<u{width}", offset=HEAD_BYTES)


def with_starts(manifest: DataFrame) -> DataFrame:
    """Adds `base`, the ids in all shards before. One row per shard, so one task can sum them."""
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.withColumn("base", F.coalesce(F.sum("tokens").over(before), F.lit(0)))


def read_tokens(manifest: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every record, read from the files and checked."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        crc = Crc32c()
        for batch in batches:
            for shard in batch.to_pylist():
                store, root = open_store(shard["folder"])
                with store.open_input_file(f"{root}/{shard['name']}.idx") as f:
                    offsets = np.frombuffer(f.read(), "<u8").astype(np.int64)
                start, at = shard["base"], 0
                with store.open_input_stream(f"{root}/{shard['name']}.rec") as f:
                    while at < len(offsets) - 1:
                        # As many whole records as fit, and one at least.
                        stop = int(np.searchsorted(offsets, offsets[at] + READ_BYTES, "right")) - 1
                        stop = max(at + 1, stop)
                        cuts = (offsets[at : stop + 1] - offsets[at]).tolist()
                        data = f.read(cuts[-1])
                        framed = [data[a:b] for a, b in zip(cuts, cuts[1:])]
                        rows = []
                        for doc, ids in map(_ids, _checked(crc, framed)):
                            check = zlib.crc32(ids.astype("<u4").tobytes())
                            rows.append((doc, start, len(ids), check))
                            start += len(ids)
                        yield _table(rows, TOKENS)
                        at = stop
                if start != shard["base"] + shard["tokens"]:
                    raise ValueError("damaged shard")

    count, parallel = manifest.count(), manifest.sparkSession.sparkContext.defaultParallelism
    tasks = min(max(1, count), max(4 * parallel, -(-count // SHARDS_PER_TASK)))
    return with_starts(manifest).repartition(tasks).mapInArrow(read, TOKENS)


def shuffled(manifest: DataFrame, seed: int = 0) -> DataFrame:
    """(doc_id, ids) of every record in a random order, each fetched alone by its offset."""

    def offsets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard in batch.to_pylist():
                store, root = open_store(shard["folder"])
                with store.open_input_file(f"{root}/{shard['name']}.idx") as f:
                    index = np.frombuffer(f.read(), "<u8").astype(np.int64)
                n = len(index) - 1
                columns = [[shard["folder"]] * n, [shard["name"]] * n, index[:-1], np.diff(index)]
                names = ["folder", "name", "at", "size"]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names)

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        crc, files = Crc32c(), {}
        for batch in batches:
            for low in range(0, batch.num_rows, TEXTS_AT_ONCE):
                framed = []
                for r in batch.slice(low, TEXTS_AT_ONCE).to_pylist():
                    key = r["folder"], r["name"]
                    if key not in files:
                        if len(files) > 64:
                            files.pop(next(iter(files))).close()
                        store, root = open_store(r["folder"])
                        files[key] = store.open_input_file(f"{root}/{r['name']}.rec")
                    framed.append(files[key].read_at(r["size"], r["at"]))
                docs = [_ids(p) for p in _checked(crc, framed)]
                columns = [
                    pa.array([d for d, _ in docs], pa.int64()),
                    pa.array([i.astype(np.int32) for _, i in docs], pa.list_(pa.int32())),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "ids"])

    places = manifest.mapInArrow(offsets, "folder string, name string, at long, size long")
    mixed = places.orderBy(F.xxhash64("name", "at", F.lit(seed)))
    return mixed.mapInArrow(fetch, "doc_id long, ids array<int>")
