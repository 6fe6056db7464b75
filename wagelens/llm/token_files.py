"""Token ids as flat binary files with 64-bit document offsets (op13).

A corpus is a folder.  Documents lie in ascending ``doc_id`` order over a list
of files, each of three parts:

``<name>.ids``  token ids, unsigned little-endian, 2 bytes where the
                vocabulary and the end id fit, else 4; no header
``<name>.off``  ``documents + 1`` unsigned 64-bit places in ``.ids``, from 0
``<name>.doc``  ``doc_id`` of each document, signed 64-bit

``manifest.json`` lists the files in order with their document, null-id and id
counts and their base: the ids of all files before, a prefix sum over the
counts.  A document's place in the corpus is its file's base plus its offset.
All parts can be memory-mapped.

Rows are dealt by range of (doc_id, text hash, row) and sorted within the
range, so neither a frequent id nor a frequent text is one task's work; a task
streams its documents into files of about ``FILE_IDS`` ids.  A file's name
holds its attempt; only files of tasks that succeeded get into the manifest,
others are deleted.

Defined results: null text is empty and has the end id alone; rows without
``doc_id`` come first, marked by the null count; repeated rows are written as
often as they occur, rows of one ``doc_id`` in the order of their text's hash;
an empty table gives a manifest without files; other columns are ignored.
"""

from __future__ import annotations

import json
import uuid
import zlib
from array import array
from unicodedata import is_normalized

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wagelens.llm.packing import byte_symbols
from wagelens.llm.shared import id_and_text, mapped, opened, scratch_path, small_batches, worker_memory

END_ID = 2
#: Ids, or documents, after which a task begins its next file.
FILE_IDS, FILE_DOCUMENTS = 1 << 26, 1 << 20
#: Chunks of text in one generation of those that a worker remembers (it has
#: two), their longest length, and the characters of new chunks encoded at once.
REMEMBERED, CHUNK, AT_ONCE = 600_000, 40, 1 << 16
#: Letters from here on are left to the tokenizer's own first cut.
LAST_LETTER = "\u0530"
#: Marks that end a chunk as a token of their own.
END_MARKS = frozenset(".,;:!?")
FILE = "part int, seq int, name string, documents long, nulls long, ids long"


def tokenizer_path() -> str:
    """The tokenizer file of the registered query; ``write`` takes any path."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class ChunkIds:
    """Ids of the chunks between ASCII white space, as bytes.

    A tokenizer that takes white space out before it merges makes no token
    that reaches over it, so the ids of a text are those of its chunks, one
    after the other.  A batch's different chunks are looked up once each and
    the ids gathered by number.  Of new chunks, plain words go straight to the
    merges, a plain word with one mark behind it is put together of the two,
    and the others are encoded many at a time: one text, cut where a chunk
    begins (the offsets of the tokens must hit every beginning, or the chunks
    are encoded one by one).

    Two generations are remembered: what the younger one lacks is taken over
    from the older one, and the older one falls away when the younger one is
    full, so frequent chunks stay."""

    def __init__(self, tokenizer, dtype: str):
        self.tokenizer, self.dtype = tokenizer, dtype
        self.code = {2: "H", 4: "I"}[np.dtype(dtype).itemsize]
        self.young: dict[str, bytes] = {"": b""}
        self.old: dict[str, bytes] = {}
        ids = lambda text: tokenizer.encode(text, add_special_tokens=False).ids
        self.merge = merge = tokenizer.model.tokenize
        self.symbols = byte_symbols()
        probes = ["the", "chunk", "qzvxk", "abcdefghijklmnopqrstuvwxyz" * 2, "öàéß", "слово"]
        parts = [[t.id for t in merge(w.encode().decode("latin-1").translate(self.symbols))] for w in probes]
        self.splits = ids("a b") == ids("a") + ids("b") and ids(" \n a") == ids("a")
        self.plain = parts == [ids(w) for w in probes] and ids("the,") == ids("the") + ids(",")
        self.lowers = ids("The") == ids("the")

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.dtype).tobytes()

    def together(self, chunks: list[str]) -> None:
        found = self.tokenizer.encode(" ".join(chunks), add_special_tokens=False)
        ids = np.array(found.ids, self.dtype)
        begin = np.cumsum([0, *(len(c) + 1 for c in chunks[:-1])])
        at = np.array([o[0] for o in found.offsets], np.int64)
        cut = np.searchsorted(at, begin)
        if len(at) == 0 or cut[-1] >= len(at) or np.any(at[cut] != begin):
            for c in chunks:
                self.young[c] = self.whole(c)
            return
        raw, size, cut = ids.tobytes(), ids.itemsize, cut.tolist() + [len(ids)]
        for c, a, b in zip(chunks, cut, cut[1:]):
            self.young[c] = raw[size * a:size * b]

    def is_word(self, chunk: str) -> bool:
        """Whether the first cut keeps the chunk whole: ASCII letters, or small
        letters up to the Cyrillic ones that normalising leaves as they are."""
        if chunk.isascii():
            return chunk.isalpha()
        return chunk.isalpha() and max(chunk) < LAST_LETTER and chunk == chunk.lower() and is_normalized("NFC", chunk)

    def word(self, word: str) -> bytes:
        """Ids of a word, straight from the merges."""
        if word.isascii():
            word = spelled = word.lower() if self.lowers else word
        else:
            spelled = word.encode().decode("latin-1").translate(self.symbols)
        found = self.young.get(word)
        if found is None:
            found = self.old.get(word)
            if found is None:
                found = array(self.code, [t.id for t in self.merge(spelled)]).tobytes()
            self.young[word] = found
        return found

    def learn(self, chunks: list[str]) -> None:
        """Make sure that ``young`` holds all of ``chunks``."""
        old, young = self.old, self.young
        other, n = [], 0
        for chunk in chunks:
            known = old.get(chunk)
            if known is not None:
                young[chunk] = known
            elif len(chunk) > CHUNK:
                young[chunk] = self.whole(chunk)
            elif self.plain and chunk[-1] in END_MARKS and self.is_word(chunk[:-1]):
                mark = young.get(chunk[-1])
                if mark is None:
                    mark = young[chunk[-1]] = self.whole(chunk[-1])
                young[chunk] = self.word(chunk[:-1]) + mark
            elif self.plain and self.is_word(chunk):
                found = self.word(chunk)
                if chunk not in young:
                    young[chunk] = found
            else:
                other.append(chunk)
                n += len(chunk)
                if n >= AT_ONCE:
                    self.together(other)
                    other, n = [], 0
        if other:
            self.together(other)

    def encode(self, column: pa.Array) -> list[bytes]:
        """Ids of each text; null: none."""
        if not self.splits:
            return [self.whole(t or "") for t in column.to_pylist()]
        if len(self.young) > REMEMBERED:
            self.old, self.young = self.young, {"": b""}
        chunks = pc.ascii_split_whitespace(column.cast(pa.large_string()).fill_null(""))
        off = chunks.offsets.to_numpy()
        coded = chunks.flatten().dictionary_encode()
        kinds, code = coded.dictionary.to_pylist(), coded.indices.to_numpy()
        young = self.young
        self.learn([k for k in kinds if k not in young])
        parts = [young[k] for k in kinds]
        size = np.dtype(self.dtype).itemsize
        ids = np.frombuffer(b"".join(parts), self.dtype)
        many = np.fromiter(map(len, parts), np.int64, len(parts)) // size
        first = np.cumsum(many) - many
        n = many[code]
        end = np.cumsum(n)
        flat = ids[np.arange(int(end[-1]) if len(end) else 0) + np.repeat(first[code] - (end - n), n)].tobytes()
        cut = (np.concatenate(([0], end))[off - off[0]] * size).tolist()
        return [flat[a:b] for a, b in zip(cut, cut[1:])]


def batch_encoder(tokenizer_path: str, dtype: str):
    """``string column -> ids as bytes, one item a row``; what it learns stays
    in the worker for the tasks that follow."""
    from tokenizers import Tokenizer

    memory, key = worker_memory(), ("chunk ids", tokenizer_path, dtype)
    if key not in memory:
        memory[key] = ChunkIds(Tokenizer.from_file(tokenizer_path), dtype)
    return memory[key].encode


def write_files(folder: str, tokenizer_path: str, end_id: int, dtype: str, file_ids: int):
    """A task's sorted documents into files; yields one manifest row a file."""
    end = np.array([end_id], dtype).tobytes()
    size = np.dtype(dtype).itemsize

    def run(batches):
        store, path = opened(folder)
        encode = batch_encoder(tokenizer_path, dtype)
        part = TaskContext.get().partitionId()
        out, rows, seq = None, [], 0
        docs, lengths, nulls, ids = [], [], 0, 0

        def close():
            out.close()
            for ending, values in (("off", np.cumsum([0, *lengths]).astype("<u8")), ("doc", np.array(docs, "<i8"))):
                with store.open_output_stream(f"{path}/{name}.{ending}") as side:
                    side.write(values.tobytes())
            rows.append((part, seq, name, len(docs), nulls, ids))

        for batch in batches:
            keys = batch.column("doc_id").to_pylist()
            for key, raw in zip(keys, encode(batch.column("text"))):
                if out is None:
                    name = f"{part:06d}-{seq:04d}-{uuid.uuid4().hex[:12]}"
                    out = store.open_output_stream(f"{path}/{name}.ids", buffer_size=1 << 20)
                    docs, lengths, nulls, ids = [], [], 0, 0
                out.write(raw + end)
                n = len(raw) // size + 1
                docs.append(key or 0)
                nulls += key is None
                lengths.append(n)
                ids += n
                if ids >= file_ids or len(docs) >= FILE_DOCUMENTS:
                    close()
                    out, seq = None, seq + 1
        if out is not None:
            close()
        columns = list(zip(*rows)) or [()] * 6
        kinds = [pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64()]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)],
                                         ["part", "seq", "name", "documents", "nulls", "ids"])

    return run


def write(docs: DataFrame, folder: str, tokenizer_path: str, end_id: int = END_ID, file_ids: int = FILE_IDS) -> dict:
    """Encode ``docs`` into the files of ``folder``; returns the manifest."""
    from tokenizers import Tokenizer

    spark = docs.sparkSession
    small_batches(spark)
    largest = max(Tokenizer.from_file(tokenizer_path).get_vocab_size(with_added_tokens=True) - 1, end_id)
    dtype = "<u2" if largest < 1 << 16 else "<u4"
    store, path = opened(folder)
    store.create_dir(path, recursive=True)
    keys = ["doc_id", "hash", "row"]
    placed = id_and_text(docs).withColumn("hash", F.xxhash64("text")).withColumn("row", F.monotonically_increasing_id())
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = placed.repartitionByRange(parts, *keys).sortWithinPartitions(*keys).select("doc_id", "text")
    # One row a file.
    files = sorted(tuple(r) for r in ordered.mapInArrow(write_files(folder, tokenizer_path, end_id, dtype, file_ids), FILE).collect())
    bases = np.cumsum([0, *(f[5] for f in files)]).tolist()
    manifest = {"dtype": dtype, "end_id": end_id, "ids": bases[-1], "documents": sum(f[3] for f in files),
                "files": [{"name": f[2], "documents": f[3], "nulls": f[4], "ids": f[5], "base": b} for f, b in zip(files, bases)]}
    remove_strays(store, path, {f[2] for f in files})
    with store.open_output_stream(f"{path}/manifest.json") as out:
        out.write(json.dumps(manifest).encode())
    return manifest


def remove_strays(store, path: str, names: set[str]) -> None:
    """Delete the parts of attempts that failed, lost a race or were replaced; other files stay."""
    import re

    from pyarrow import fs

    part = re.compile(r"(\d{6}-\d{4}-[0-9a-f]{12})\.(ids|off|doc)").fullmatch
    for info in store.get_file_info(fs.FileSelector(path)):
        found = part(info.base_name)
        if found and found[1] not in names:
            store.delete_file(info.path)


class TokenFiles:
    """Random access to the documents of a folder, over memory-mapped parts."""

    def __init__(self, folder: str):
        self.store, self.path = opened(folder)
        with self.store.open_input_stream(f"{self.path}/manifest.json") as file:
            self.manifest = json.loads(file.read())
        self.first = np.cumsum([0, *(f["documents"] for f in self.manifest["files"])])

    def parts(self, k: int):
        """(ids, offsets, doc ids) of file ``k``."""
        name = f"{self.path}/{self.manifest['files'][k]['name']}"
        kinds = (("ids", self.manifest["dtype"]), ("off", "<u8"), ("doc", "<i8"))
        return tuple(mapped(self.store, f"{name}.{ending}", dtype) for ending, dtype in kinds)

    def __len__(self) -> int:
        return int(self.first[-1])

    def __getitem__(self, i: int) -> np.ndarray:
        """Ids of the ``i``-th document, end id included."""
        if not 0 <= i < len(self):
            raise IndexError(i)
        k = int(np.searchsorted(self.first, i, side="right")) - 1
        ids, off, _ = self.parts(k)
        a, b = (int(o) for o in off[i - self.first[k]:i - self.first[k] + 2])
        return ids[a:b]


def read_files(folder: str, rows: int = 4096):
    def run(batches):
        corpus = TokenFiles(folder)
        for batch in batches:
            for k in batch.column("id").to_pylist():
                file = corpus.manifest["files"][k]
                ids, off, doc = corpus.parts(k)
                off = off.astype(np.int64)
                for a in range(0, len(doc), rows):
                    b = min(a + rows, len(doc))
                    crc = [zlib.crc32(ids[off[i]:off[i + 1]].astype("<u4").tobytes()) for i in range(a, b)]
                    missing = np.arange(a, b) < file["nulls"]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.asarray(doc[a:b]), mask=missing), pa.array(file["base"] + off[a:b]),
                         pa.array(off[a + 1:b + 1] - off[a:b]), pa.array(crc, pa.int64())],
                        ["doc_id", "start", "n_tokens", "ids_crc32"])

    return run


def read(spark: SparkSession, folder: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of each document, from the files: a task a file."""
    n = len(TokenFiles(folder).manifest["files"])
    return spark.range(0, n, 1, max(1, n)).mapInArrow(
        read_files(folder), "doc_id long, start long, n_tokens long, ids_crc32 long")


def round_trip(docs: DataFrame, tokenizer_path: str, end_id: int = END_ID) -> DataFrame:
    """Write ``docs`` below the shared folder and read the files back."""
    spark = docs.sparkSession
    folder = scratch_path(spark, "token-files")
    write(docs, folder, tokenizer_path, end_id)
    return read(spark, folder)
