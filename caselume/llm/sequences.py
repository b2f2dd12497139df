"""Token ids in Arrow stream files of equal-length sequences.

A file holds the documents of one range of ids, in order. Its batches have three
columns of fixed-size lists: ``input_ids``, ``attention_mask`` (false in the padding
of the last sequence) and ``document_end`` (true at the last id of a document). A second
small stream beside it holds the ids of its documents. All lists have the same length, so a
memory-mapped file gives any sequence without a copy.
"""

from __future__ import annotations

import os
import re
import uuid
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.scale import staging_dir
from ..session import ship_package
from .common import Spans, small_batches, stage, staged_map, trimmed

LENGTH, BATCH = 2048, 128
#: Memory for ids of words that have come before, for each Python worker.
KNOWN_WORDS = 1_200_000

_MARK_AFTER_MARK = re.compile(r"[,.](?<![A-Za-z0-9À-ÖØ-öø-ÿ][,.])")
_BEFORE_SPACE = re.compile(r"(?<=\S)(?= )")
_DOUBLE = ("  ", " \n", "\n ", "\n\n")
#: White space but the space and the line end.
_OTHER = [chr(c) for c in range(0x3001) if chr(c).isspace() and chr(c) not in " \n"]
_OTHER_ASCII = [c for c in _OTHER if c.isascii()]
#: What a byte says about chunks: it begins one, it is a mark that may begin one, the next byte begins one.
_BEGINS, _MARK, _ALONE = 1, 2, 4
_KINDS = np.zeros(256, np.uint8)
_KINDS[[ord(" "), ord("\n")]], _KINDS[[ord(","), ord(".")]] = _BEGINS, _MARK
_KINDS[ord("\n")] |= _ALONE


def is_plain(text: str) -> bool:
    """Whether each run of white space is one space or line end, inside the text. Then no pre-token reaches over the begin of a
    space, over a line end, or over a comma or full stop after a letter or digit."""
    if not text or text[0] in " \n" or text[-1] in " \n":
        return False
    return not any(d in text for d in _DOUBLE) and not any(c in text for c in (_OTHER_ASCII if text.isascii() else _OTHER))


def chunk_starts(buffer: np.ndarray, begins: np.ndarray, with_marks: list[bool]) -> np.ndarray:
    """Where chunks begin in plain texts that lie one after the other."""
    kinds = _KINDS[buffer]
    for i, ok in enumerate(with_marks):
        if not ok:
            own = kinds[begins[i] : begins[i + 1] if i + 1 < len(begins) else None]
            own &= ~np.uint8(_MARK)
    flags = (kinds & (_BEGINS | _MARK)) > 0
    flags[1:] |= (kinds[:-1] & _ALONE) > 0
    flags[begins] = True
    return np.flatnonzero(flags)


def _grown(a: np.ndarray, n: int) -> np.ndarray:
    if n <= len(a):
        return a
    out = np.zeros(max(n, 2 * len(a)), a.dtype)
    out[: len(a)] = a
    return out


class _Known:
    """Chunks that have come before and their ids: one hash table with open addressing, all of it in arrays."""

    def __init__(self, dtype: np.dtype):
        self.n = self.used = self.filled = 0
        self.text, self.ids = np.zeros(1 << 16, np.uint8), np.zeros(1 << 16, dtype)
        self.start, self.size, self.first, self.count = (np.zeros(1 << 12, np.int64) for _ in range(4))
        self.hash, self.slots = np.zeros(1 << 12, np.uint64), np.full(1 << 14, -1, np.int64)
        self.spans = Spans(self.text, self.start[:0], self.size[:0], padded=True)

    def find(self, spans: Spans, hashes: np.ndarray) -> np.ndarray:
        """The number of each span's chunk, -1 for one that is not known. Bytes are compared."""
        out = np.full(len(hashes), -1, np.int64)
        open_, step, mask = np.arange(len(hashes)), 0, np.uint64(len(self.slots) - 1)
        while len(open_):
            held = self.slots[((hashes[open_] + np.uint64(step)) & mask).astype(np.int64)]
            some = held >= 0
            open_, held = open_[some], held[some]
            same = self.hash[held] == hashes[open_]
            at = np.flatnonzero(same)
            same[at] = spans.same(open_[at], self.spans, held[at])
            out[open_[same]] = held[same]
            open_ = open_[~same]
            step += 1
        return out

    def add(self, chunks: list[bytes], hashes: np.ndarray, ids: np.ndarray, counts: np.ndarray) -> None:
        """New, different chunks with their ids, one after the other, and the count of each."""
        n, m = self.n, self.n + len(chunks)
        sizes = np.fromiter(map(len, chunks), np.int64, len(chunks))
        for name in ("start", "size", "first", "count", "hash"):
            setattr(self, name, _grown(getattr(self, name), m))
        self.start[n:m], self.size[n:m] = self.used + np.cumsum(sizes) - sizes, sizes
        self.first[n:m], self.count[n:m] = self.filled + np.cumsum(counts) - counts, counts
        self.hash[n:m] = hashes
        used, filled = self.used + int(sizes.sum()), self.filled + int(counts.sum())
        self.text, self.ids = _grown(self.text, used + 8), _grown(self.ids, filled)
        self.text[self.used : used] = np.frombuffer(b"".join(chunks), np.uint8)
        self.ids[self.filled : filled] = ids
        self.n, self.used, self.filled = m, used, filled
        self.spans = Spans(self.text, self.start[:m], self.size[:m], padded=True)
        if 2 * m > len(self.slots):
            self.slots = np.full(1 << (4 * m - 1).bit_length(), -1, np.int64)
            self._place(np.arange(m))
        else:
            self._place(np.arange(n, m))

    def _place(self, which: np.ndarray) -> None:
        step, mask = 0, np.uint64(len(self.slots) - 1)
        while len(which):
            slot = ((self.hash[which] + np.uint64(step)) & mask).astype(np.int64)
            empty = self.slots[slot] < 0
            self.slots[slot[empty]] = which[empty]
            which = which[self.slots[slot] != which]
            step += 1

    def ids_of(self, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of chunks one after the other, and the count of each."""
        counts = self.count[which]
        ends = np.cumsum(counts)
        total = int(ends[-1]) if len(ends) else 0
        return self.ids[np.repeat(self.first[which] - ends + counts, counts) + np.arange(total)], counts


def _is_word(chunk: bytes) -> bool:
    """Letters, with a space before them or without."""
    word = chunk.removeprefix(b" ")
    return word.isalpha() if word.isascii() else word.decode().isalpha()


class Encoder:
    """A file of the tokenizers library, with a bounded memory of encoded chunks."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer, pre_tokenizers

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.known = _Known(self.dtype)
        lone = self.tokenizer.encode("\n", add_special_tokens=False).ids
        self.line = lone[0] if len(lone) == 1 else None
        # Letters alone, with or without a space before, are one pre-token, so they can go to the model on lines of their own. Bytes
        # have printable characters as names in its vocabulary.
        printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
        self.byte_names = {b: b for b in printable} | {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in printable)}
        self.on_lines = Tokenizer(self.tokenizer.model)
        self.on_lines.pre_tokenizer = pre_tokenizers.Split(chr(self.byte_names[10]), "isolated")
        samples = [" the", "letters", "é", " ñandúes", "日本語", " ÜBER"]
        same = self._by_lines([w.encode() for w in samples])
        self.by_model = same is not None and same[0].tobytes() == b"".join(x.tobytes() for x in self._batch(samples))

    def _batch(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, self.dtype) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _by_lines(self, chunks: list[bytes]) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids and counts of pre-tokens without a line end, from the model alone; none if its line ends don't show."""
        text = b"\n".join(chunks).decode("latin-1").translate(self.byte_names)
        ids = np.array(self.on_lines.encode_batch_fast([text], add_special_tokens=False)[0].ids, self.dtype)
        is_line = ids == self.line if self.line is not None else np.zeros(len(ids), bool)
        cuts = np.flatnonzero(is_line)
        if len(cuts) != len(chunks) - 1:
            return None
        return ids[~is_line], np.diff(np.concatenate([[-1], cuts, [len(ids)]])) - 1

    def _learn(self, chunks: list[bytes], hashes: np.ndarray) -> None:
        letters = np.fromiter(map(_is_word, chunks), bool, len(chunks)) if self.by_model else np.zeros(len(chunks), bool)
        at, done, ids, counts = np.flatnonzero(letters), [], [], []
        for i in range(0, len(at), 256):
            some = at[i : i + 256].tolist()
            found = self._by_lines([chunks[j] for j in some])
            if found is not None:
                done += some
                ids.append(found[0])
                counts.append(found[1])
        letters[:] = False
        letters[done] = True
        rest = np.flatnonzero(~letters).tolist()
        for x in self._batch([chunks[j].decode() for j in rest]):
            ids.append(x)
            counts.append(np.array([len(x)], np.int64))
        order = done + rest
        self.known.add([chunks[j] for j in order], hashes[order], np.concatenate(ids), np.concatenate(counts))

    def encode(self, texts: list[str]) -> list[bytes]:
        """Raw ids of each text; the same as encoding it whole."""
        out = [b""] * len(texts)
        parts, owner, with_marks = [], [], []
        for i, text in enumerate(texts):
            if is_plain(text):
                parts.append(text.encode())
                owner.append(i)
                with_marks.append(not _MARK_AFTER_MARK.search(text))
            elif text:
                # White space of other kinds: cut where a space follows a character that is none.
                out[i] = self._joined(_BEFORE_SPACE.split(text))
        if parts:
            sizes = np.fromiter(map(len, parts), np.int64, len(parts))
            buffer, ends = np.frombuffer(b"".join(parts), np.uint8), np.cumsum(sizes)
            start = chunk_starts(buffer, ends - sizes, with_marks)
            ids, counts = self._looked_up(buffer, start, np.diff(np.append(start, len(buffer))))
            total = np.cumsum(counts)
            raw, size, at = ids.tobytes(), self.dtype.itemsize, 0
            for i, last in zip(owner, np.searchsorted(start, ends).tolist()):
                z = int(total[last - 1]) * size
                out[i], at = raw[at:z], z
        return out

    def _joined(self, chunks: list[str]) -> bytes:
        raw = [c.encode() for c in chunks]
        size = np.fromiter(map(len, raw), np.int64, len(raw))
        return self._looked_up(np.frombuffer(b"".join(raw), np.uint8), np.cumsum(size) - size, size)[0].tobytes()

    def _looked_up(self, buffer: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        spans = Spans(buffer, start, size)
        hashes = spans.hashes(np.zeros(len(start), np.uint64))
        found = self.known.find(spans, hashes)
        missing = np.flatnonzero(found < 0)
        if len(missing):
            fresh = _different(buffer, start, size, missing)
            if self.known.n + len(fresh) > KNOWN_WORDS:
                self.known, missing = _Known(self.dtype), np.arange(len(start))
                fresh = _different(buffer, start, size, missing)
            self._learn(list(fresh), hashes[list(fresh.values())])
            found[missing] = self.known.find(Spans(buffer, start[missing], size[missing]), hashes[missing])
        return self.known.ids_of(found)


def _different(buffer: np.ndarray, start: np.ndarray, size: np.ndarray, which: np.ndarray) -> dict[bytes, int]:
    """The different chunks among those named, each with its first place."""
    raw, out = buffer.tobytes(), {}
    for i, a, z in zip(which.tolist(), start[which].tolist(), (start + size)[which].tolist()):
        out.setdefault(raw[a:z], i)
    return out


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    return Encoder(path)


def _open(uri: str):
    from pyarrow import fs

    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri[5:]
    return fs.FileSystem.from_uri(uri)


class _Writer:
    """Cuts a stream of ids into sequences and writes them in batches of equal size."""

    def __init__(self, sink, length: int, batch: int, dtype: np.dtype):
        kind = pa.uint16() if dtype.itemsize == 2 else pa.uint32()
        self.schema = pa.schema([
            ("input_ids", pa.list_(kind, length)), ("attention_mask", pa.list_(pa.bool_(), length)), ("document_end", pa.list_(pa.bool_(), length)),
        ])
        self.out = pa.ipc.new_stream(sink, self.schema)
        self.length, self.size = length, length * batch
        self.ids, self.ends, self.used = np.zeros(self.size, dtype), np.zeros(self.size, bool), 0

    def add(self, ids: np.ndarray) -> None:
        at = 0
        while at < len(ids):
            n = min(len(ids) - at, self.size - self.used)
            self.ids[self.used : self.used + n] = ids[at : at + n]
            self.used, at = self.used + n, at + n
            if at == len(ids):
                self.ends[self.used - 1] = True
            if self.used == self.size:
                self.flush()

    def flush(self) -> None:
        if self.used:
            n = -(-self.used // self.length) * self.length
            self.ids[self.used : n] = 0
            mask = np.arange(n) < self.used
            columns = [self.ids[:n], mask, self.ends[:n]]
            self.out.write_batch(pa.RecordBatch.from_arrays(
                [pa.FixedSizeListArray.from_arrays(pa.array(c), self.length) for c in columns], schema=self.schema
            ))
            self.used = 0
            self.ends[:] = False

    def close(self) -> None:
        self.flush()
        self.out.close()


def write_sequences(
    docs: DataFrame, path: str, tokenizer: str, end_id: int = 0, length: int = LENGTH, batch: int = BATCH, parts: int | None = None
) -> DataFrame:
    """Encodes ``text`` and writes sequence files under ``path``; returns the manifest.

    The manifest has one row per file: ``part`` (files in order of their documents),
    ``file``, ``docs``, ``tokens`` and ``start`` (tokens of all files before it). Documents
    are in ascending order of ``doc_id``, null ids first, equal ids in order of their text's
    hash; a null text counts as empty and gives the end id alone. Rows are dealt by ranges,
    so no task sorts more than its range, and each task streams: it holds one batch
    of texts and one of sequences. A task that is run again writes files of other names, and
    the manifest names those of the attempt that counted. Other columns are not read.
    """
    spark = docs.sparkSession
    ship_package(spark)
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("tie", F.xxhash64("text"))
    parts = parts or max(1, rows.rdd.getNumPartitions())
    kind = pa.schema([("doc_id", pa.int64())])

    def run(batches):
        from pyspark import TaskContext

        part, name, n_docs, n_tokens = TaskContext.get().partitionId(), uuid.uuid4().hex, 0, 0
        store, folder = _open(path)
        code = encoder(tokenizer)
        end = np.array([end_id], code.dtype)
        base = f"{folder}/part-{part:06d}-{name}"
        out = ids_out = None
        for rows in batches:
            if not rows.num_rows:
                continue
            if out is None:
                store.create_dir(folder, recursive=True)
                sink, ids_sink = store.open_output_stream(f"{base}.arrow"), store.open_output_stream(f"{base}.docs.arrow")
                out, ids_out = _Writer(sink, length, batch, code.dtype), pa.ipc.new_stream(ids_sink, kind)
            for raw in code.encode(rows.column("text").to_pylist()):
                out.add(ids := np.concatenate([np.frombuffer(raw, code.dtype), end]))
                n_tokens += len(ids)
            n_docs += rows.num_rows
            ids_out.write_batch(pa.RecordBatch.from_arrays([rows.column("doc_id").cast(pa.int64())], schema=kind))
        if out is not None:
            for writer, file in ((out, sink), (ids_out, ids_sink)):
                writer.close()
                file.close()
            yield pa.RecordBatch.from_pydict({"part": [part], "file": [f"{path}/part-{part:06d}-{name}"], "docs": [n_docs], "tokens": [n_tokens]})

    ordered = rows.repartitionByRange(parts, "doc_id", "tie").sortWithinPartitions("doc_id", "tie").drop("tie")
    files = staged_map(ordered, run, "part long, file string, docs long, tokens long")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each file
    return files.withColumn("start", F.coalesce(F.sum("tokens").over(before), F.lit(0)))


def documents_of(file: str):
    """Reads a file back: (doc_id, number of ids, their crc32) for each document, in order."""
    store, base = _open(file)
    with store.open_input_stream(f"{base}.docs.arrow") as s:
        names = (x for b in pa.ipc.open_stream(s) for x in b.column(0).to_pylist())
        with store.open_input_stream(f"{base}.arrow") as t:
            size = crc = 0
            for b in pa.ipc.open_stream(t):
                valid = int(np.count_nonzero(b.column("attention_mask").flatten().to_numpy(zero_copy_only=False)))
                ids = b.column("input_ids").flatten().to_numpy()[:valid].astype("<u4")
                ends = np.flatnonzero(b.column("document_end").flatten().to_numpy(zero_copy_only=False)[:valid])
                at = 0
                for e in (ends + 1).tolist():
                    yield next(names), size + e - at, zlib.crc32(ids[at:e], crc)
                    at, size, crc = e, 0, 0
                size, crc = size + valid - at, zlib.crc32(ids[at:], crc)


def read_documents(manifest: DataFrame) -> DataFrame:
    """From the files alone: ``doc_id``, ``start``, ``n_tokens``, ``ids_crc32`` for each document."""
    spark = manifest.sparkSession
    ship_package(spark)

    def run(batches):
        for rows in batches:
            for file, at in zip(rows.column("file").to_pylist(), rows.column("start").to_pylist()):
                held: list[tuple] = []
                for name, n, crc in documents_of(file):
                    held.append((name, at, n, crc))
                    at += n
                    if len(held) == 5000:
                        yield _rows(held)
                        held = []
                if held:
                    yield _rows(held)

    def _rows(held):
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*held)], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    files = stage(manifest).select("file", "start")
    with small_batches(spark):
        return stage(files.repartition(max(1, spark.sparkContext.defaultParallelism * 2), "file").mapInArrow(trimmed(run), "doc_id long, start long, n_tokens long, ids_crc32 long"))


class Sequences:
    """Random access to a local file: ``s[i]`` gives views (ids, mask, ends), without a copy of the ids."""

    def __init__(self, file: str):
        self.table = pa.ipc.open_stream(pa.memory_map(f"{file}.arrow")).read_all()
        self.rows = self.table.column("input_ids").chunk(0) if self.table.num_rows else []
        self.per_batch = len(self.rows)

    def __len__(self) -> int:
        return self.table.num_rows

    def __getitem__(self, i: int):
        if not 0 <= i < len(self):
            raise IndexError(i)
        chunk, row = divmod(i, self.per_batch)
        return tuple(self.table.column(c).chunk(chunk)[row].values.to_numpy(zero_copy_only=c == "input_ids") for c in self.table.column_names)


def new_folder(spark: SparkSession) -> str:
    return f"{staging_dir(spark)}/caselume/sequences-{uuid.uuid4().hex}"
