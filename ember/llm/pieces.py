"""SentencePiece encoding and decoding through a table of distinct chunks.

When no piece holds a white-space marker after another sign, no merge crosses
the place where a marker follows a sign. The marked text then falls apart into
chunks, markers followed by other signs, that are segmented independently, and
the ids decode chunk by chunk as well. Neighbouring rows of a file form blocks,
bounded in rows and bytes. Each block sends its distinct chunks, in the order
they are met and packed by hash bucket, to the bucket's task, where every
distinct chunk of the corpus is segmented and decoded once. Back come lengths
and ids alone (and decoded texts, where they differ from the chunk): the block
finds its chunks again in the same order and joins the ids by position. A common
word thus travels once per block, never once per occurrence.

Defined results: a null text is empty and has no ids; strings of control
pieces inside a text are plain text, as the library has it; repeated rows are
encoded each; null ids stay null. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import json
import re
import zlib
from array import array
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import packed, shuffle_width, unpacked
from .exact_dedup import located
from .words import span_bytes, utf8

MARK = "▁"
CHUNK = re.compile(" +[^ ]*")
PACK_ROWS = 1024
PLAIN = 64  # bytes under which compression only costs


@lru_cache(maxsize=4)
def load(path: str):
    """The model, if chunks may be segmented on their own with it."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    inner = re.compile(f"[^{MARK}]{MARK}")
    if any(inner.search(model.id_to_piece(i)) for i in range(model.get_piece_size())):
        raise ValueError(f"{path}: a piece crosses a white-space marker")
    for probe in ("a  b ", " a", "ﬁ　Ａ", "é\t\n"):
        if model.normalize(probe) != MARK + probe.replace(" ", MARK):
            raise ValueError(f"{path}: the model normalises its input")
    return model


def chunks(text: str) -> list[str]:
    """Chunks of the marked text, without their first marker and with spaces
    for the others, so that the library's dummy prefix restores them."""
    if MARK in text:
        text = text.replace(MARK, " ")
    if not text:
        return []
    if "  " not in text and text[0] != " " and text[-1] != " ":
        return text.split(" ")
    return [c[1:] for c in CHUNK.findall(" " + text)]


def by_bucket(seen, buckets: int) -> dict[int, list[str]]:
    """Distinct chunks by bucket, in the order given."""
    held: dict[int, list[str]] = {}
    for chunk in seen:
        held.setdefault(zlib.crc32(chunk.encode()) % buckets, []).append(chunk)
    return held


def shrunk(body: bytes) -> bytes:
    if len(body) <= PLAIN:
        return b"\0" + body
    return b"\1" + len(body).to_bytes(4, "little") + pa.compress(body, codec="zstd", asbytes=True)


def grown(body: bytes) -> bytes:
    if body[0] == 0:
        return body[1:]
    return pa.decompress(body[5:], int.from_bytes(body[1:5], "little"), codec="zstd", asbytes=True)


def question(asked: list[str]) -> bytes:
    """Lengths (in characters) and signs of some chunks."""
    lengths = np.fromiter(map(len, asked), np.int32, len(asked))
    small = bool(lengths.max(initial=0) < 256)
    return shrunk(bytes([small]) + len(asked).to_bytes(4, "little")
                  + (lengths.astype(np.uint8) if small else lengths).tobytes() + "".join(asked).encode())


def questioned(body: bytes) -> list[str]:
    body = grown(body)
    kind, n = np.dtype(np.uint8 if body[0] else np.int32), int.from_bytes(body[1:5], "little")
    ends = np.cumsum(np.frombuffer(body, kind, n, 5), dtype=np.int64).tolist()
    text = body[5 + n * kind.itemsize:].decode()
    return [text[a:b] for a, b in zip([0, *ends], ends)]


def answer(lengths: np.ndarray, ids: np.ndarray, odd: dict[int, str]) -> bytes:
    """Lengths, ids (two bytes each if they fit) and the decoded texts that are
    not the chunk itself."""
    small, narrow = bool(lengths.max(initial=0) < 256), bool(ids.max(initial=0) < 65536)
    texts = json.dumps(odd).encode() if odd else b""
    return shrunk(bytes([small, narrow]) + np.array([len(lengths), len(ids)], np.int32).tobytes()
                  + lengths.astype(np.uint8 if small else np.int32).tobytes()
                  + ids.astype(np.uint16 if narrow else np.int32).tobytes() + texts)


def answered(body: bytes):
    body = grown(body)
    n, total = np.frombuffer(body, np.int32, 2, 2).tolist()
    kinds = np.dtype(np.uint8 if body[0] else np.int32), np.dtype(np.uint16 if body[1] else np.int32)
    at = 10 + n * kinds[0].itemsize
    end = at + total * kinds[1].itemsize
    odd = {int(k): v for k, v in json.loads(body[end:]).items()} if len(body) > end else {}
    return np.frombuffer(body, kinds[0], n, 10), np.frombuffer(body, kinds[1], total, at), odd


def blocks(it, rows: int, size: int):
    """((file, first row), batches) of runs of neighbouring rows of a file: at
    most ``rows`` rows and, unless one text is longer, ``size`` bytes. Both
    passes over a scan find the same ones."""
    head, held, n, total = None, [], 0, 0
    for batch in it:
        file, at = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        length = np.diff(utf8(batch.column(3))[1]).tolist()
        lo = 0
        for i in range(batch.num_rows):
            if head is not None and (n == rows or total + length[i] > size or file[i] != head[0]):
                if i > lo:
                    held.append(batch.slice(lo, i - lo))
                yield head, held
                head, held, n, total, lo = None, [], 0, 0, i
            if head is None:
                head = (int(file[i]), int(at[i]))
            n, total = n + 1, total + length[i]
        if batch.num_rows > lo:
            held.append(batch.slice(lo))
    if head is not None:
        yield head, held


def packed_texts(rows: DataFrame, most: int, size: int) -> DataFrame:
    """(file, at, doc_id, text) -> compressed packs of every block's rows."""
    def pack(it):
        for (file, at), parts in blocks(it, most, size):
            for part in parts:
                for lo in range(0, part.num_rows, PACK_ROWS):
                    some = part.slice(lo, PACK_ROWS)
                    body = packed(pa.RecordBatch.from_arrays(some.columns[2:], names=["doc_id", "text"]))
                    yield pa.RecordBatch.from_pylist([{"file": file, "at": at, "place": some.column(1)[0].as_py(), "body": body}])

    return rows.mapInArrow(pack, "file long, at long, place long, body binary")


def packed_chunks(rows: DataFrame, buckets: int, most: int, size: int) -> DataFrame:
    """(file, at, doc_id, text) -> the distinct chunks of each block, by bucket."""
    def send(it):
        for (file, at), parts in blocks(it, most, size):
            seen = dict.fromkeys(chain.from_iterable(chunks(t or "") for p in parts for t in p.column(3).to_pylist()))
            held = list(by_bucket(seen, buckets).items())
            for lo in range(0, len(held), 256):
                yield pa.RecordBatch.from_pylist([
                    {"bucket": b, "file": file, "at": at, "body": question(c)}
                    for b, c in held[lo:lo + 256]])

    return rows.mapInArrow(send, "bucket long, file long, at long, body binary")


def segment(packs: DataFrame, path: str) -> DataFrame:
    """Segment and decode every distinct chunk of a bucket once; one answer per pack."""
    def group(table: pa.Table) -> pa.Table:
        pa.default_memory_pool().release_unused()  # what earlier groups left
        model = load(path)
        asked = [questioned(b) for b in table.column("body").to_pylist()]
        place = {chunk: i for i, chunk in enumerate(dict.fromkeys(chain.from_iterable(asked)))}
        before = model.encode("a")
        ids = model.encode(list(place), num_threads=1)
        if "" in place:  # a lone marker at a text's end
            ids[place[""]] = model.encode("a ")[len(before):]
        start = len(model.decode(before))
        decoded = [t[start:] for t in model.decode([before + each for each in ids])]
        odd = {i: t for (chunk, i), t in zip(place.items(), decoded) if t != " " + chunk}
        ends = np.cumsum([len(each) for each in ids])
        starts = np.concatenate(([0], ends[:-1]))
        flat = np.fromiter(chain.from_iterable(ids), np.int32, ends[-1])
        answers = []
        for wanted in asked:
            at = np.fromiter(map(place.__getitem__, wanted), np.int64, len(wanted))
            answers.append(answer(ends[at] - starts[at], span_bytes(flat, starts[at], ends[at])[0],
                                  {k: odd[i] for k, i in enumerate(at.tolist()) if i in odd} if odd else {}))
        return pa.table({"file": table.column("file"), "at": table.column("at"), "bucket": table.column("bucket"),
                         "body": pa.array(answers, pa.binary())})

    return packs.groupBy("bucket").applyInArrow(group, "file long, at long, bucket long, body binary")


DIGESTS = {"doc_id": ("long", pa.int64()), "n_tokens": ("long", pa.int64()), "ids_sha256": ("string", pa.string()),
           "decoded_sha256": ("string", pa.string())}
OUTPUTS = {"ids": ("array<int>", pa.list_(pa.int32())), "decoded": ("string", pa.string())}


def encoded(docs: DataFrame, path: str, *, id_col: str = "doc_id", text_col: str = "text",
            outputs: tuple[str, ...] = ("ids", "decoded"), block_rows: int = 2048, block_bytes: int = 8 << 20,
            buckets: int | None = None) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 and ``outputs`` for every row.

    ``block_rows`` and ``block_bytes`` bound the neighbouring rows that one task
    holds together; ``buckets`` (twice the session's shuffle partitions) divide
    the table of chunks."""
    spark = docs.sparkSession
    load(path)  # fails early for a model whose pieces cross markers
    buckets = buckets or 2 * shuffle_width(spark)
    rows = located(docs).select(F.col("__file").alias("file"), F.col("__at").alias("at"),
                                F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    table = segment(packed_chunks(rows, buckets, block_rows, block_bytes), path)
    columns = DIGESTS | {name: OUTPUTS[name] for name in outputs}

    def join(texts: pa.Table, answers: pa.Table) -> pa.Table:
        pa.default_memory_pool().release_unused()
        bodies = [body for _, body in sorted(zip(texts.column("place").to_pylist(), texts.column("body").to_pylist()))]
        # the number of every chunk of the block in reading order; its strings are kept once
        place: dict[str, int] = {}
        numbers, sizes = array("i"), []
        for body in bodies:
            for text in unpacked(body).column(1).to_pylist():
                found = chunks(text or "")
                numbers.extend([place.setdefault(c, len(place)) for c in found])
                sizes.append(len(found))
        at = np.concatenate((np.zeros(1, np.int64), np.cumsum(sizes, dtype=np.int64)))
        numbers = np.frombuffer(numbers, np.int32)
        held = by_bucket(place, buckets)
        written, starts, ends = [""] * len(place), np.zeros(len(place), np.int64), np.zeros(len(place), np.int64)
        flat, total, odd = [], 0, {}
        for bucket, body in zip(answers.column("bucket").to_pylist(), answers.column("body").to_pylist()):
            lengths, ids, differ = answered(body)
            spelt, lo = list(map(str, ids.tolist())), 0
            for chunk, n in zip(held[bucket], lengths.tolist()):
                written[place[chunk]] = ",".join(spelt[lo:lo + n])
                lo += n
            mine = [place[c] for c in held[bucket]]
            ends[mine] = total + np.cumsum(lengths, dtype=np.int64)
            starts[mine] = ends[mine] - lengths
            flat.append(ids)
            total += len(ids)
            odd.update((place[held[bucket][k]], t) for k, t in differ.items())
        chunk_of = list(place) if odd else []
        places = np.concatenate((np.zeros(1, np.int64), np.cumsum((ends - starts)[numbers])))[at]
        out = {"doc_id": [], "n_tokens": pa.array(np.diff(places)), "ids_sha256": [], "decoded_sha256": [], "decoded": []}
        row = 0
        for body in bodies:
            part = unpacked(body)
            out["doc_id"] += part.column(0).to_pylist()
            for text in part.column(1).to_pylist():
                mine = numbers[at[row]:at[row + 1]].tolist()
                row += 1
                # every chunk decodes to itself after a space, but for the odd ones; the first space goes
                decoded = (text or "").replace(MARK, " ")
                if odd and not odd.keys().isdisjoint(mine):
                    decoded = "".join([odd[i] if i in odd else " " + chunk_of[i] for i in mine])[1:]
                out["ids_sha256"].append(hashlib.sha256(",".join([written[i] for i in mine]).encode()).hexdigest())
                out["decoded_sha256"].append(hashlib.sha256(decoded.encode()).hexdigest())
                if "decoded" in columns:
                    out["decoded"].append(decoded)
        if "ids" in columns:
            flat = np.concatenate(flat) if flat else np.zeros(0, np.int32)
            ids, _ = span_bytes(flat, starts[numbers], ends[numbers])
            out["ids"] = pa.ListArray.from_arrays(pa.array(places, pa.int32()), pa.array(ids.astype(np.int32)))
        return pa.table({name: out[name] if isinstance(out[name], pa.Array) else pa.array(out[name], kind)
                         for name, (_, kind) in columns.items()})

    schema = ", ".join(f"{name} {kind}" for name, (kind, _) in columns.items())
    return packed_texts(rows, block_rows, block_bytes).groupBy("file", "at").cogroup(
        table.groupBy("file", "at")).applyInArrow(join, schema)
