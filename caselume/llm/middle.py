"""Fill-in-the-middle over seekable compressed frames.

A text is stored as independent zstandard frames of at most ``FRAME`` code points, each with
the number of code points before it. To cut a text at two places, the frames that hold them are
found in these counts, and only they are decompressed; all others go into the output as they are.
Digests and restored texts come from the output's frames, one after the other.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import ship_package
from .common import give_back, small_batches, staged_map

#: Code points of a frame.
FRAME = 65_536
#: The marks before each part, and the order of the parts by form.
MARKS = {"prefix": b"<P>", "suffix": b"<S>", "middle": b"<M>"}
ORDER = {"psm": ("prefix", "suffix", "middle"), "spm": ("suffix", "prefix", "middle")}

STORE = "doc_id long, n long, marked boolean, starts array<long>, frames array<binary>"
KINDS = pa.schema([
    ("doc_id", pa.int64()), ("n", pa.int64()), ("marked", pa.bool_()), ("starts", pa.list_(pa.int64())), ("frames", pa.list_(pa.binary())),
])


def units(data: bytes) -> int:
    """Code points of whole UTF-8 characters."""
    return len(data) if data.isascii() else len(data.decode())


def at_unit(data: bytes, unit: int) -> int:
    """Byte at which code point ``unit`` starts."""
    return unit if data.isascii() else len(data.decode()[:unit].encode())


def pieces(data: bytes, size: int) -> Iterator[bytes]:
    """``data`` in pieces of ``size`` code points; the last one may be shorter."""
    at = 0
    while at < len(data):
        step = data[at : at + 4 * size]  # a code point takes four bytes at most
        if len(step) > size:
            if not step.isascii():
                step = step.decode(errors="ignore")[:size].encode()
            else:
                step = step[:size]
        yield step
        at += len(step)


def store_frames(docs: DataFrame, text: str = "text", frame: int = FRAME) -> DataFrame:
    """The texts as frames, written to the shared folder.

    A row for each row of ``docs``: ``doc_id``, ``n`` (code points), ``marked`` (a mark occurs
    in the text), ``starts`` (code points before each frame) and ``frames``. Null and empty texts have no frame.
    ``doc_id`` may be null or repeated; other columns are not read. A task holds a batch of texts and one frame.
    """
    ship_package(docs.sparkSession)

    def run(batches):
        press = zstandard.ZstdCompressor(level=3)
        for rows in batches:
            out = []
            for data in rows.column("text").to_pylist():
                starts, frames, n = [], [], 0
                for piece in pieces(data, frame):
                    starts.append(n)
                    frames.append(press.compress(piece))
                    n += units(piece)
                out.append((n, any(m in data for m in MARKS.values()), starts, frames))
            columns = [rows.column("doc_id").cast(pa.int64()), *(pa.array(c, f.type) for c, f in zip(zip(*out), list(KINDS)[1:]))]
            if out:
                yield pa.RecordBatch.from_arrays(columns, schema=KINDS)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("text"))
    return staged_map(rows, run, STORE, compression="uncompressed")


def draw(store: DataFrame, seed: int = 1, plain_from: int = 90, spm_below: int = 20) -> DataFrame:
    """Adds ``form`` and the cuts ``low`` and ``high`` (code points), drawn from ``seed`` and ``doc_id``.

    A null ``doc_id`` is drawn as an empty string. Cuts are null where the form is plain.
    """
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)

    def number(i: int) -> Column:
        return F.conv(F.substring("_digest", 8 * i + 1, 8), 16, 10).cast("long")

    first, second = number(0) % (F.col("n") + 1), number(1) % (F.col("n") + 1)
    plain = (F.col("n") == 0) | F.col("marked") | (number(2) % 100 >= plain_from)
    form = F.when(plain, "plain").when(number(3) % 100 < spm_below, "spm").otherwise("psm")
    drawn = store.withColumn("_digest", digest).withColumn("form", form)
    cut = F.col("form") != "plain"
    return drawn.withColumn("low", F.when(cut, F.least(first, second))).withColumn("high", F.when(cut, F.greatest(first, second))).drop("_digest")


class Frames:
    """The frames of one text, cut by code points; of them the two last opened stay decompressed."""

    def __init__(self, starts: list[int], frames: list[bytes]):
        self.starts, self.frames = starts, frames
        self.open = zstandard.ZstdDecompressor().decompress
        self.held: dict[int, bytes] = {}

    def data(self, i: int) -> bytes:
        if i not in self.held:
            self.held = dict([*self.held.items()][-1:]) | {i: self.open(self.frames[i])}
        return self.held[i]

    def between(self, low: int, high: int, n: int) -> Iterator[tuple[bytes, bytes]]:
        """(frame, b"") for whole frames and (b"", bytes) for what a cut leaves of one."""
        i = max(0, bisect_right(self.starts, low) - 1)
        while low < high:
            start, end = self.starts[i], self.starts[i + 1] if i + 1 < len(self.starts) else n
            if low == start and end <= high:
                yield self.frames[i], b""
            else:
                data = self.data(i)
                yield b"", data[at_unit(data, low - start) : at_unit(data, min(high, end) - start)]
            low, i = min(high, end), i + 1


def output_frames(form: str, n: int, low: int, high: int, text: Frames, press) -> Iterator[bytes]:
    """The output as frames: whole ones as they were stored, marks and cut ends as new ones."""
    if form == "plain":
        yield from text.frames
        return
    spans, loose = {"prefix": (0, low), "middle": (low, high), "suffix": (high, n)}, []
    for part in ORDER[form]:
        loose.append(MARKS[part])
        for whole, cut in text.between(*spans[part], n):
            if whole:
                if loose:
                    yield press(b"".join(loose))
                    loose = []
                yield whole
            else:
                loose.append(cut)
    if loose:
        yield press(b"".join(loose))


def streamed(frames: Iterable[bytes]) -> Iterator[bytes]:
    """The bytes of ordered frames, one frame at a time."""
    unpress = zstandard.ZstdDecompressor().decompress
    for frame in frames:
        yield unpress(frame)


def parts_of(chunks: Iterable[bytes], form: str) -> Iterator[tuple[str, bytes]]:
    """(part, bytes) of an output, read once from left to right.

    The marks are found in the stream, in the order of the form, even where they reach over
    two chunks. A text with a mark is never cut, so the first mark of a kind is the one that was set.
    """
    if form == "plain":
        for chunk in chunks:
            yield "prefix", chunk
        return
    order, at, held = ORDER[form], -1, b""
    for chunk in chunks:
        held += chunk
        while at + 1 < len(order):
            mark = MARKS[order[at + 1]]
            place = held.find(mark)
            if place < 0:
                break
            if at >= 0:
                yield order[at], held[:place]
            held, at = held[place + len(mark) :], at + 1
        keep = 2 if at + 1 < len(order) else 0  # a mark may have begun
        if at >= 0 and len(held) > keep:
            yield order[at], held[: len(held) - keep]
            held = held[len(held) - keep :]
    if at >= 0 and held:
        yield order[at], held


def restored(chunks: Iterable[bytes], form: str) -> Iterator[bytes]:
    """The text of an output, from the output and its form alone.

    What comes later in the text than in the output, the suffix, waits in compressed frames.
    """
    press, waiting = zstandard.ZstdCompressor(level=1).compress, []
    for part, data in parts_of(chunks, form):
        if part == "suffix":
            waiting.append(press(data))
        else:
            yield data
    yield from streamed(waiting)


def _digest(chunks: Iterable[bytes]) -> str:
    out = hashlib.sha256()
    for chunk in chunks:
        out.update(chunk)
    return out.hexdigest()


def _joined(chunks: Iterable[bytes]) -> bytes:
    return b"".join(chunks)


def _over_outputs(drawn: DataFrame, function, kind: pa.DataType, names: list[str]) -> DataFrame:
    """A row for each text: its measures, and ``names`` as ``function(form, output frames)`` gives them."""
    ship_package(drawn.sparkSession)
    types = {pa.string(): "string", pa.binary(): "binary", pa.list_(pa.binary()): "array<binary>"}
    schema = "doc_id long, n long, form string, prefix_chars long, middle_chars long, " + ", ".join(f"{c} {types[kind]}" for c in names)

    def run(batches):
        press = zstandard.ZstdCompressor(level=3).compress
        for rows in batches:
            if not rows.num_rows:
                continue
            cells = [rows.column(c).to_pylist() for c in ("form", "n", "low", "high")]
            out = []
            for i, (form, n, low, high) in enumerate(zip(*cells)):
                text = Frames(rows.column("starts")[i].as_py(), rows.column("frames")[i].as_py())
                out.append(function(form, list(output_frames(form, n, low, high, text, press))))
            low, high = rows.column("low"), rows.column("high")
            middle = pc.subtract(high, low)
            yield pa.RecordBatch.from_arrays(
                [rows.column("doc_id"), rows.column("n"), rows.column("form"), low, middle, *(pa.array(c, kind) for c in zip(*out))],
                names=["doc_id", "n", "form", "prefix_chars", "middle_chars", *names],
            )
        give_back()

    with small_batches(drawn.sparkSession):
        return drawn.select("doc_id", "n", "form", "low", "high", "starts", "frames").mapInArrow(run, schema)


def fill_in_middle(docs: DataFrame, seed: int = 1, frame: int = FRAME, as_text: bool = False) -> DataFrame:
    """Outputs for all ``docs``: ``doc_id``, ``n``, ``form``, ``prefix_chars``, ``middle_chars``, ``output``.

    ``output`` is an array of frames, or with ``as_text`` the text. The prefix ends after the smaller of two drawn
    places and the middle after the larger. The form is plain (the text as it is) for empty texts, for texts
    that hold a mark and for a drawn tenth, spm for a drawn fifth of the others, else psm. Null texts count as
    empty; repeated rows get the same output; a null ``doc_id`` is drawn as an empty string.
    """
    drawn = draw(store_frames(docs, frame=frame), seed)
    if as_text:
        made = _over_outputs(drawn, lambda form, frames: (_joined(streamed(frames)),), pa.binary(), ["output"])
        return made.withColumn("output", F.decode("output", "UTF-8"))
    return _over_outputs(drawn, lambda form, frames: (frames,), pa.list_(pa.binary()), ["output"])


def digests(docs: DataFrame, seed: int = 1, frame: int = FRAME) -> DataFrame:
    """As ``fill_in_middle``, with ``output_sha256`` and ``restored_sha256`` in place of the output."""

    def both(form, frames):
        return _digest(streamed(frames)), _digest(restored(streamed(frames), form))

    return _over_outputs(draw(store_frames(docs, frame=frame), seed), both, pa.string(), ["output_sha256", "restored_sha256"])
