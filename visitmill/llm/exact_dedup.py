"""Exact duplicates: full texts meet in Patricia tries, one per partition of (length, content hash).

Every task first inserts the texts it reads into a trie of its own, so that a text with a third of all
rows leaves a task once. What is left is shuffled by length and content hash, and the trie of each
partition compares whole byte strings; its terminal nodes keep the owner. A trie over its memory bound
writes its largest subtree to the task's scratch folder and goes through that part on its own later.
"""

from __future__ import annotations

import hashlib
import os
import pickle
import tempfile
from collections.abc import Callable, Iterator
from typing import Any

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from visitmill.functions import skew
from visitmill.llm.common import BLANKS, query, slices, table
from visitmill.session import cut_lineage

# Bytes of keys and nodes that one trie holds before it spills or flushes.
TRIE_BYTES = 96 * 1024 * 1024
NODE_BYTES = 400

OWNERS = "length long, content_hash long, body binary, n_chars long, owner long, n long"
FOUND = "text_sha256 string, keep_id long, keep_chars long, group_size long"


def _common(a: bytes, b: bytes, start: int) -> int:
    """How many bytes ``a`` and ``b[start:]`` share at the front."""
    low, high = 0, min(len(a), len(b) - start)
    while low < high:
        middle = (low + high + 1) // 2
        if b.startswith(a[:middle], start):
            low = middle
        else:
            high = middle - 1
    return low


class Trie:
    """Compressed radix trie from byte strings to values that merge.

    A node is a list: label, children by first byte, value (None: no string ends here).
    """

    def __init__(self, merge: Callable[[Any, Any], Any], most: int = TRIE_BYTES):
        self.merge, self.most, self.size = merge, most, 0
        self.root: list = [b"", {}, None]

    def insert(self, key: bytes, value: Any) -> None:
        node, at = self.root, 0
        while at < len(key):
            child = node[1].get(key[at])
            if child is None:
                node[1][key[at]] = [key[at:], {}, value]
                self.size += len(key) - at + NODE_BYTES
                return
            label = child[0]
            if not key.startswith(label, at):
                same = _common(label, key, at)
                # The edge splits where the strings part.
                upper = [label[:same], {label[same]: child}, None]
                child[0] = label[same:]
                node[1][key[at]] = upper
                self.size += NODE_BYTES
                child, label = upper, upper[0]
            node, at = child, at + len(label)
        node[2] = value if node[2] is None else self.merge(node[2], value)

    @property
    def full(self) -> bool:
        return self.size > self.most

    def items(self, node: list | None = None, before: bytes = b"") -> Iterator[tuple[bytes, Any]]:
        stack = [(node or self.root, before)]
        while stack:
            here, prefix = stack.pop()
            prefix += here[0]
            if here[2] is not None:
                yield prefix, here[2]
            stack.extend((child, prefix) for child in here[1].values())

    def cut_largest(self) -> tuple[bytes, list[tuple[bytes, Any]]]:
        """Take the largest subtree below the first fork out; its prefix and what it held."""
        node, prefix = self.root, b""
        while len(node[1]) == 1 and node[2] is None:
            (child,) = node[1].values()
            if not child[1]:
                break
            node, prefix = child, prefix + child[0]

        def weight(top: list) -> int:
            total, stack = 0, [top]
            while stack:
                here = stack.pop()
                total += len(here[0]) + NODE_BYTES
                stack.extend(here[1].values())
            return total

        sizes = {first: weight(child) for first, child in node[1].items()}
        first = max(sizes, key=sizes.get)
        found = list(self.items(node[1].pop(first), prefix))
        self.size -= sizes[first]
        return prefix + bytes([first]), found


def owners(
    pairs: Iterator[tuple[bytes, Any]], merge: Callable[[Any, Any], Any], folder: str, most: int = TRIE_BYTES
) -> Iterator[tuple[bytes, Any]]:
    """Each distinct string once with its merged value, in bounded memory."""
    trie = Trie(merge, most)
    spilled: dict[bytes, Any] = {}
    lengths: list[int] = []
    for key, value in pairs:
        out = next((spilled[key[:n]] for n in lengths if key[:n] in spilled), None)
        if out is not None:
            pickle.dump((key, value), out)
            continue
        trie.insert(key, value)
        while trie.full and len(trie.root[1]) and trie.size > NODE_BYTES * 4:
            prefix, found = trie.cut_largest()
            if len(found) == 1 and not trie.root[1]:
                trie.insert(*found[0])  # one string alone is held, however long
                break
            out = spilled[prefix] = open(os.path.join(folder, f"{len(spilled)}-{prefix[:8].hex()}"), "w+b")  # noqa: SIM115
            # The longest prefix first: what once went to a file keeps going there.
            lengths = sorted({len(p) for p in spilled}, reverse=True)
            for item in found:
                pickle.dump(item, out)
    yield from trie.items()
    del trie

    def reread(file) -> Iterator[tuple[bytes, Any]]:
        file.seek(0)
        while True:
            try:
                yield pickle.load(file)
            except EOFError:
                return

    for file in spilled.values():
        with tempfile.TemporaryDirectory(dir=folder) as below:
            yield from owners(reread(file), merge, below, most)
        file.close()
        os.unlink(file.name)


def better(a: tuple, b: tuple) -> tuple:
    """Of two (characters, id, rows): the longer original, then the smaller id; a null id comes last."""
    rows = a[2] + b[2]
    first = min(a, b, key=lambda v: (-v[0], v[1] is None, v[1] or 0))
    return (*first[:2], rows)


def normal_bytes(text: str | None) -> bytes:
    return (text or "").encode().translate(None, BLANKS.encode())


def _batches(rows: Iterator[tuple], schema: pa.Schema, most: int) -> Iterator[pa.RecordBatch]:
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row[2]) if isinstance(row[2], bytes) else 64
        if size > most or len(held) >= 20_000:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), schema.types)], schema=schema)
            held, size = [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*held), schema.types)], schema=schema)


def local_owners(most: int = TRIE_BYTES) -> Callable:
    """Task function before the shuffle: distinct texts of the task, each with its best row so far."""
    schema = pa.schema(
        [("length", pa.int64()), ("content_hash", pa.int64()), ("body", pa.binary()), ("n_chars", pa.int64()), ("owner", pa.int64()), ("n", pa.int64())]
    )

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        trie = Trie(better, most)

        def flush() -> Iterator[tuple]:
            for key, (n_chars, owner, n) in trie.items():
                yield len(key), xxhash.xxh3_64_intdigest(key) - (1 << 63), key, n_chars, owner, n

        for batch in batches:
            for part in slices(batch, "text"):
                for doc_id, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    trie.insert(normal_bytes(text), (len(text or ""), doc_id, 1))
                    if trie.full:
                        yield from flush()
                        trie = Trie(better, most)
        yield from flush()

    return lambda batches: _batches(rows(batches), schema, 8 * 1024 * 1024)


def merged_owners(most: int = TRIE_BYTES) -> Callable:
    """Task function after the shuffle: one trie per partition; one row per distinct text."""
    schema = pa.schema(
        [("text_sha256", pa.string()), ("keep_id", pa.int64()), ("keep_chars", pa.int64()), ("group_size", pa.int64())]
    )

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            for part in slices(batch, "body"):
                columns = [part.column(n).to_pylist() for n in ("body", "n_chars", "owner", "n")]
                for body, *value in zip(*columns):
                    yield body, tuple(value)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        with tempfile.TemporaryDirectory(prefix="trie-") as folder:
            for body, (n_chars, owner, n) in owners(pairs(batches), better, folder, most):
                yield hashlib.sha256(body).hexdigest(), owner, n_chars, n

    return lambda batches: _batches(rows(batches), schema, 8 * 1024 * 1024)


def normal(text: Column) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), BLANKS, "")


def exact_dedup(
    docs: DataFrame, *, id_column: str = "doc_id", text_column: str = "text", trie_bytes: int = TRIE_BYTES
) -> DataFrame:
    """One row per document: which document of its group of equal texts stays.

    Texts are equal if they are the same without blanks. The longest original stays, then the smallest
    id. Returns ``id_column, keep_id, group_size, kept, text_sha256, n_chars``; other columns of ``docs``
    are not read. A null text is empty, and empty texts are equal. ``group_size`` counts rows. Rows that
    repeat an id and a length within a group are one document and share the mark; a null id stays only
    where its group has no other of that length. An empty table gives no rows.
    """
    named = docs.select(F.col(id_column).alias("doc_id"), F.col(text_column).alias("text"))
    first = named.mapInArrow(local_owners(trie_bytes), OWNERS)
    found = first.repartition(F.col("length"), F.col("content_hash")).mapInArrow(merged_owners(trie_bytes), FOUND)
    # The digest names a text from here on; the tries have compared the texts themselves.
    kept = cut_lineage(found)
    light = cut_lineage(
        named.select(
            "doc_id",
            F.sha2(normal(F.col("text")).cast("binary"), 256).alias("text_sha256"),
            F.coalesce(F.length("text"), F.lit(0)).cast("long").alias("n_chars"),
        )
    )
    joined = skew.lookup_join(light, kept, ["text_sha256"], row_id=["doc_id"], how="inner")
    stays = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("n_chars") == F.col("keep_chars"))
    return joined.select(
        F.col("doc_id").alias(id_column), "keep_id", "group_size", stays.alias("kept"), "text_sha256", "n_chars"
    )


@query(
    r"""
    WITH t AS (
        SELECT doc_id, coalesce(text, '') AS original,
               regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS normal FROM documents
    )
    SELECT doc_id,
           first_value(doc_id) OVER (PARTITION BY normal ORDER BY length(original) DESC, doc_id) AS keep_id,
           count(*) OVER (PARTITION BY normal) AS group_size,
           doc_id = first_value(doc_id) OVER (PARTITION BY normal ORDER BY length(original) DESC, doc_id) AS kept,
           sha256(normal) AS text_sha256
    FROM t
    """
)
def op1_exact_dedup(spark, folder):
    """Every document with the owner of its text."""
    return exact_dedup(table(spark, folder, "documents")).drop("n_chars")
