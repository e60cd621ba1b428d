"""Filling fixed-capacity containers with documents that lie next to each other on a Hilbert curve."""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from noticelake.llm.tokens import shipped
from noticelake.runtime import cut

#: Tokens of a container, and documents looked at at a time along the curve.
CAPACITY, WINDOW = 2048, 4096
#: Dimensions of the curve, bits of a coordinate, and features that tokens are hashed to.
DIMS, BITS, FEATURES = 3, 10, 1 << 12


def hilbert_key(points: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Place of each row of ``points`` (integers under 2**bits) on the Hilbert curve through the cube, by Skilling's transform."""
    x = points.astype(np.uint32).T.copy()
    n = len(x)
    q = np.uint32(1 << (bits - 1))
    while q > 1:  # undo the excess work of each level
        p = np.uint32(q - 1)
        for i in range(n):
            on = (x[i] & q) != 0
            swap = np.where(on, 0, (x[0] ^ x[i]) & p).astype(np.uint32)
            x[0] ^= np.where(on, p, swap).astype(np.uint32)
            x[i] ^= swap
        q >>= np.uint32(1)
    for i in range(1, n):  # Gray code
        x[i] ^= x[i - 1]
    t = np.zeros_like(x[0])
    q = np.uint32(1 << (bits - 1))
    while q > 1:
        t ^= np.where((x[n - 1] & q) != 0, q - 1, 0).astype(np.uint32)
        q >>= np.uint32(1)
    x ^= t
    key = np.zeros(x.shape[1], np.int64)
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            key = key << 1 | ((x[i] >> np.uint32(b)) & 1).astype(np.int64)
    return key


def projection() -> np.ndarray:
    """FEATURES x DIMS random signs: the axes that hashed token counts are projected on."""
    return np.random.default_rng(7).choice(np.array([-1.0, 1.0]), (FEATURES, DIMS))


def hashed(ids: np.ndarray) -> np.ndarray:
    """The feature of each token id: its top bits after multiplication by an odd number near 2**32 divided by the golden ratio."""
    return (ids.astype(np.uint64) * np.uint64(2654435769) % np.uint64(1 << 32)) >> np.uint64(32 - FEATURES.bit_length() + 1)


def grid(total: np.ndarray, size: int) -> list[int]:
    """A document's projected token counts, scaled by its length, as a cell of the grid."""
    z = total / np.sqrt(max(size, 1)) / 4
    return [int(v) for v in np.minimum((1 / (1 + np.exp(-z)) * (1 << BITS)), (1 << BITS) - 1)]


def sized_documents(documents: DataFrame, capacity: int = CAPACITY, vocabulary: str | None = None) -> DataFrame:
    """(doc_id, part_no, start_token, n_tokens, hilbert): the items of every document.

    A document is one item unless it exceeds the capacity; then it is cut into full containers and a rest. Null and empty texts
    are items of 0 tokens. The key is of the whole document, so the parts of one lie together.
    """
    encoder = shipped(documents, vocabulary)
    names = ["doc_id", "part_no", "start_token", "n_tokens", "hilbert"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        e = encoder()
        axes = projection()[hashed(np.arange(len(e.widths)))]
        for b in batches:
            docs, sizes, cells = b.column(0).to_pylist(), [], []
            for packed in e.packed(b.column(1).to_pylist()):
                ids = np.frombuffer(packed, np.int32)
                sizes.append(len(ids))
                cells.append(grid(axes[ids].sum(axis=0), len(ids)))
            if docs:
                keys = hilbert_key(np.asarray(cells)).tolist()
                rows = [(d, k + 1, s, min(capacity, n - s), h) for d, n, h in zip(docs, sizes, keys, strict=True) for k, s in enumerate(range(0, max(n, 1), capacity))]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64()), strict=True)], names)

    return documents.select("doc_id", "text").mapInArrow(run, "doc_id bigint, part_no int, start_token int, n_tokens int, hilbert bigint")


class Packer:
    """Best fit, largest first, over one window of neighbours at a time; every container with room stays open for the next windows."""

    def __init__(self, capacity: int, first: int) -> None:
        self.capacity, self.next = capacity, first
        self.boxes: dict[int, list[int]] = {}  # room -> containers that have just that
        self.rooms: list[int] = []  # its keys, sorted: at most ``capacity`` of them, however many containers are open

    def window(self, items: list[tuple]) -> Iterator[tuple]:
        """(container, offset, item) for each (size, …) item."""
        for item in sorted(items, key=lambda x: -x[0]):
            i = bisect_left(self.rooms, item[0])
            if item[0] == self.capacity or i == len(self.rooms):
                room, box = self.capacity, self.next
                self.next += 1
            else:
                room = self.rooms[i]
                box = self.boxes[room].pop()
                if not self.boxes[room]:
                    del self.boxes[room], self.rooms[i]
            yield box, self.capacity - room, item
            left = room - item[0]
            if left in self.boxes:
                self.boxes[left].append(box)
            elif left:
                self.boxes[left] = [box]
                insort(self.rooms, left)


def pack(documents: DataFrame, capacity: int = CAPACITY, window: int = WINDOW, vocabulary: str | None = None) -> DataFrame:
    """(container_id, place, doc_id, part_no, start_token, n_tokens): every item of every document in exactly one container.

    Items are range-sorted by Hilbert key (ties by a hash of doc_id, so that many equal texts spread over tasks) and each task packs its stretch
    of the curve in order; a container is of one stretch. ``place`` is the item's first token in its container.
    """
    items = cut(sized_documents(documents, capacity, vocabulary))
    items = items.repartitionByRange("hilbert", F.xxhash64("doc_id", "part_no"), "doc_id", "part_no").sortWithinPartitions("hilbert", F.xxhash64("doc_id", "part_no"), "doc_id", "part_no")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        packer, held = Packer(capacity, TaskContext.get().partitionId() << 40), []

        def flush() -> pa.RecordBatch:
            rows = [(box, place, d, k, s, n) for box, place, (n, d, k, s) in packer.window(held)]
            types = (pa.int64(), pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.int32())
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], ["container_id", "place", "doc_id", "part_no", "start_token", "n_tokens"])

        for b in batches:
            for d, k, s, n in zip(*(b.column(i).to_pylist() for i in range(4)), strict=True):
                held.append((n, d, k, s))
                if len(held) >= window:
                    yield flush()
                    held = []
        if held:
            yield flush()

    return items.select("doc_id", "part_no", "start_token", "n_tokens").mapInArrow(run, "container_id bigint, place int, doc_id bigint, part_no int, start_token int, n_tokens int")


def fill_report(packed: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """How full the containers are: n_containers, n_items, n_tokens, fill (share of all room that is used)."""
    each = packed.groupBy("container_id").agg(F.sum("n_tokens").cast("bigint").alias("t"), F.count("*").alias("n"))
    return each.agg(F.count("*").alias("n_containers"), F.sum("n").alias("n_items"), F.sum("t").alias("n_tokens"), (F.sum("t") / (F.count("*") * F.lit(capacity))).alias("fill"))
