"""Product codes of integer vectors, learned exactly over Hilbert-sorted flat blocks.

A vector's components become ``floor(scale * x)`` and are cut into equal parts.
Tasks pack the vectors of their partition into chunks; in a chunk every part is
sorted along a Hilbert curve of its own and cut into flat blocks of ``BLOCK``
rows. A block stores the box of its rows (least and largest component) and their
sums. The chunks are written once to the shared folder; no vector is shuffled.

A round compares boxes with the codebook: an entry whose least distance to the box
is above another entry's largest one can be no row's nearest, so a block keeps a
short list of the others. A block with one entry on its list adds its stored
sums; the others run a small integer kernel over rows and list. Sums and
distances are int64 throughout, so the codebooks do not depend on how rows
fall into chunks, blocks or tasks. What comes to the driver is one row for each
part and entry.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.llm.common import cut, free_name

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
BLOCK = 32
#: Components in a chunk, which bounds its memory whatever the vectors' length.
CHUNK = 1 << 20
_KEY_BITS = 62
_LARGEST = 1 << 30


def hilbert_keys(points: np.ndarray) -> np.ndarray:
    """Place of each integer point (rows, dims) on a Hilbert curve through the box of all points.

    Of more than 31 dimensions the first 31 are used: the key orders rows, nothing else depends on it.
    """
    x = points[:, :_KEY_BITS // 2]
    n, dims = x.shape
    if not n or not dims:
        return np.zeros(n, np.uint64)
    bits = min(12, _KEY_BITS // dims)
    low, span = x.min(0), np.maximum(1, x.max(0) - x.min(0))
    axes = [np.minimum((1 << bits) - 1, ((x[:, k] - low[k]) * (1 << bits)) // (span[k] + 1)).astype(np.uint64)
            for k in range(dims)]
    one = np.uint64(1)
    # from axes to the transposed index: undo the curve's turns from the highest bit down, then Gray code
    for b in range(bits - 1, 0, -1):
        q, p = np.uint64(1 << b), np.uint64((1 << b) - 1)
        for k in range(dims):
            turned = (axes[k] & q) != 0
            swap = np.where(turned, np.uint64(0), (axes[0] ^ axes[k]) & p)
            axes[0] = np.where(turned, axes[0] ^ p, axes[0] ^ swap)
            axes[k] = axes[k] ^ swap if k else axes[0]
    for k in range(1, dims):
        axes[k] = axes[k] ^ axes[k - 1]
    turn = np.zeros(n, np.uint64)
    for b in range(bits - 1, 0, -1):
        turn ^= np.where((axes[-1] >> np.uint64(b)) & one != 0, np.uint64((1 << b) - 1), np.uint64(0))
    key = np.zeros(n, np.uint64)
    for b in range(bits - 1, -1, -1):
        for a in axes:
            key = key << one | ((a ^ turn) >> np.uint64(b)) & one
    return key


def pack(vectors: np.ndarray, parts: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """For each part of the (rows, dims) integers: (order, low, high, sums), blocks of ``BLOCK`` rows of the order."""
    width = vectors.shape[1] // parts
    starts = np.arange(0, len(vectors), BLOCK)
    out = []
    for p in range(parts):
        own = vectors[:, p * width:(p + 1) * width]
        order = np.argsort(hilbert_keys(own), kind="stable")
        rows = own[order]
        out.append((order.astype(np.int32), np.minimum.reduceat(rows, starts), np.maximum.reduceat(rows, starts),
                    np.add.reduceat(rows, starts)))
    return out


def shortlists(low: np.ndarray, high: np.ndarray, book: np.ndarray) -> np.ndarray:
    """(blocks, entries) booleans: the entries that may be the nearest of some point of the block's box."""
    gap = np.maximum(0, np.maximum(low[:, None] - book, book - high[:, None]))
    far = np.maximum(np.abs(book - low[:, None]), np.abs(book - high[:, None]))
    least, most = (gap * gap).sum(2), (far * far).sum(2)
    return least <= most.min(1)[:, None]


def nearest(rows: np.ndarray, near: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(entry, squared distance) of each row, in blocks of ``BLOCK`` rows with their short lists; ties to the lower entry."""
    n, width = rows.shape
    blocks = len(near)
    padded = np.zeros((blocks * BLOCK, width), np.int64)
    padded[:n] = rows
    padded = padded.reshape(blocks, BLOCK, width)
    entry, dist = np.empty((blocks, BLOCK), np.int64), np.empty((blocks, BLOCK), np.int64)
    lengths = near.sum(1)
    for length in np.unique(lengths):
        own = np.flatnonzero(lengths == length)
        listed = np.nonzero(near[own])[1].reshape(len(own), length)   # ascending entries
        found = np.zeros((len(own), BLOCK, length), np.int64)
        for k in range(width):
            d = padded[own, :, k][:, :, None] - book[listed, k][:, None, :]
            found += d * d
        best = found.argmin(2)
        entry[own] = np.take_along_axis(listed, best, 1)
        dist[own] = np.take_along_axis(found, best[:, :, None], 2)[:, :, 0]
    return entry.ravel()[:n], dist.ravel()[:n]


def _chunks(dims: int, parts: int, scale: int):
    """Arrow function: (vec_id, label, embedding) to chunks of packed vectors."""
    rows_in_chunk = max(1, CHUNK // max(1, dims))

    def run(batches):
        held, size = [], 0
        for batch in batches:
            at = 0
            while at < batch.num_rows:
                piece = batch.slice(at, rows_in_chunk - size)
                held.append(piece)
                at, size = at + piece.num_rows, size + piece.num_rows
                if size == rows_in_chunk:
                    yield chunk(held)
                    held, size = [], 0
        if held:
            yield chunk(held)

    def chunk(held):
        table = pa.Table.from_batches(held).combine_chunks()
        lists = table.column(2).chunk(0)
        lengths = lists.value_lengths().to_numpy()
        flat = np.floor(scale * lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64))
        if len(flat) and np.abs(flat).max() * np.sqrt(max(1, dims)) >= _LARGEST:
            raise ArithmeticError(f"components beyond {_LARGEST / scale / np.sqrt(dims):.0f}: squared distances pass a long")
        vectors = np.zeros((table.num_rows, dims), np.int64)
        if dims:
            row = np.repeat(np.arange(table.num_rows), lengths)
            first = np.cumsum(lengths) - lengths
            vectors[row, np.arange(len(flat)) - first[row]] = flat.astype(np.int64)
        packed = pack(vectors, parts)
        blob = lambda k: b"".join(x[k].astype("<i8").tobytes() for x in packed)
        order = b"".join(x[0].astype("<i4").tobytes() for x in packed)
        return pa.RecordBatch.from_arrays(
            [_list_of(table.column(0)), _list_of(table.column(1)), pa.array([vectors.astype("<i4").tobytes()], pa.binary()),
             pa.array([order], pa.binary()), *[pa.array([blob(k)], pa.binary()) for k in (1, 2, 3)]],
            ["vec_ids", "labels", "vectors", "orders", "low", "high", "sums"])
    return run


def _list_of(column: pa.ChunkedArray) -> pa.Array:
    whole = column.combine_chunks()
    whole = whole.chunk(0) if isinstance(whole, pa.ChunkedArray) else whole
    return pa.ListArray.from_arrays(pa.array([0, len(whole)], pa.int32()), whole)


def _unpacked(batch, dims: int, parts: int):
    """(row number, vectors, for each part: (order, low, high, sums)) of the chunks of a batch."""
    width = dims // parts
    vectors, orders, low, high, sums = (batch.column(batch.schema.get_field_index(c)).to_pylist() for c in (
        "vectors", "orders", "low", "high", "sums"))
    counts = batch.column(batch.schema.get_field_index("vec_ids")).value_lengths().to_numpy()
    for k, n in enumerate(counts):
        boxes = [np.frombuffer(x[k], "<i8").reshape(parts, -1, width) if width else np.zeros((parts, -(-n // BLOCK), 0), np.int64)
                 for x in (low, high, sums)]
        order = np.frombuffer(orders[k], "<i4").reshape(parts, n)
        whole = np.frombuffer(vectors[k], "<i4").reshape(n, dims).astype(np.int64)
        yield k, whole, [(order[p], *(b[p] for b in boxes)) for p in range(parts)]


def _sums(book: np.ndarray, dims: int, parts: int):
    """Arrow function: one row for each part and entry that rows of the chunks are nearest to."""
    width, entries = dims // parts, book.shape[1]

    def run(batches):
        total = np.zeros((parts, entries, width), np.int64)
        count = np.zeros((parts, entries), np.int64)
        for batch in batches:
            for _, vectors, packed in _unpacked(batch, dims, parts):
                for p, (order, low, high, sums) in enumerate(packed):
                    near = shortlists(low, high, book[p])
                    sizes = np.full(len(low), BLOCK)
                    sizes[-1] = len(order) - BLOCK * (len(low) - 1)
                    whole = near.sum(1) == 1
                    entry = near[whole].argmax(1)
                    np.add.at(total[p], entry, sums[whole])
                    np.add.at(count[p], entry, sizes[whole])
                    open_ = np.flatnonzero(~whole)
                    if len(open_):
                        at = (open_[:, None] * BLOCK + np.arange(BLOCK)).ravel()
                        at = at[at < len(order)]
                        rows = vectors[order[at], p * width:(p + 1) * width]
                        entry, _ = nearest(rows, near[open_], book[p])
                        count[p] += np.bincount(entry, minlength=entries)
                        np.add.at(total[p], entry, rows)
        used = np.argwhere(count > 0)
        if len(used):
            yield pa.RecordBatch.from_arrays(
                [pa.array(used[:, 0], pa.int32()), pa.array(used[:, 1], pa.int32()),
                 pa.array(count[used[:, 0], used[:, 1]], pa.int64()),
                 pa.array(list(total[used[:, 0], used[:, 1]]), pa.list_(pa.int64()))], ["part", "entry", "n", "sums"])
    return run


def _assign(shared, dims: int, parts: int, id_type: str, label_type: str):
    width = dims // parts
    def run(batches):  # noqa: E306
        book = shared.value
        for batch in batches:
            ids, labels = batch.column(0), batch.column(1)
            for k, vectors, packed in _unpacked(batch, dims, parts):
                codes = np.zeros((len(vectors), parts), np.uint8)
                error = np.zeros(len(vectors), np.int64)
                for p, (order, low, high, _) in enumerate(packed):
                    entry, dist = nearest(vectors[order, p * width:(p + 1) * width], shortlists(low, high, book[p]), book[p])
                    codes[order, p] = entry
                    error[order] += dist
                text = codes.tobytes().hex()
                step = 2 * parts
                yield pa.RecordBatch.from_arrays(
                    [ids[k].values, labels[k].values,
                     pa.array([text[i:i + step] for i in range(0, len(text), step)], pa.string()), pa.array(error)],
                    ["vec_id", "label", "code", "error"])
    return run


def kept_vectors(vectors: DataFrame, id_col: str, vector_col: str, label_col: str) -> DataFrame:
    """(vec_id, label, embedding) of the rows whose vector is there and all finite."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return vectors.where(F.col(vector_col).isNotNull() & F.forall(vector_col, finite)).select(
        F.col(id_col).alias("vec_id"), F.col(label_col).alias("label"), F.col(vector_col).alias("embedding"))


def encode(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
           parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> tuple[DataFrame, np.ndarray]:
    """((vec_id, label, code, error) of the kept rows, the codebooks as (parts, entries, width)).

    Rows whose vector is null or holds a null or non-finite component are left
    out; null ids and labels stay. A vector shorter than the longest one, or a
    length that ``parts`` does not divide, is filled up with zeros. The codebooks
    start from the ``entries`` rows of the smallest ids (null ids last, ties by
    the vector); with fewer rows there are fewer entries. Repeated rows are
    coded each and count each. An empty table gives empty codebooks. A component so
    large that squared distances would pass a long is an error. Other columns are not read.
    """
    if not 1 <= entries <= 256:
        raise ValueError("entries must lie between 1 and 256: a code is one byte a part")
    spark = vectors.sparkSession
    kept = kept_vectors(vectors, id_col, vector_col, label_col)
    longest = kept.agg(F.coalesce(F.max(F.size("embedding")), F.lit(0)).alias("n")).first()["n"]
    dims = -(-longest // parts) * parts
    first = kept.select("vec_id", "embedding").orderBy(F.asc_nulls_last("vec_id"), "embedding").limit(entries).collect()
    start = np.zeros((len(first), dims), np.int64)
    for k, r in enumerate(first):
        wide = np.floor(scale * np.array(r["embedding"], np.float64))
        start[k, :len(wide)] = np.clip(wide, -_LARGEST, _LARGEST)   # a component beyond that fails in its chunk
    book = np.ascontiguousarray(start.reshape(len(first), parts, dims // parts).swapaxes(0, 1))
    kinds = {f.name: f.dataType.simpleString() for f in kept.schema}
    chunks = cut(kept.mapInArrow(
        _chunks(dims, parts, scale), f"vec_ids array<{kinds['vec_id']}>, labels array<{kinds['label']}>, vectors binary, "
        "orders binary, low binary, high binary, sums binary"), "vector-chunks")
    for _ in range(rounds if len(first) else 0):
        parts_of = chunks.mapInArrow(_sums(book, dims, parts), "part int, entry int, n long, sums array<long>")
        # every component's sum apart: at most parts * entries rows come back
        total = parts_of.groupBy("part", "entry").agg(
            F.sum("n").alias("n"), *[F.sum(F.get("sums", F.lit(k))).alias(f"s{k}") for k in range(dims // parts)]).collect()
        book = book.copy()
        for r in total:
            book[r["part"], r["entry"]] = [r[f"s{k}"] // r["n"] for k in range(dims // parts)]
    shared = spark.sparkContext.broadcast(book)
    coded = chunks.mapInArrow(_assign(shared, dims, parts, kinds["vec_id"], kinds["label"]),
                              f"vec_id {kinds['vec_id']}, label {kinds['label']}, code string, error long")
    return coded, book


def codebook_digest(book: np.ndarray) -> str:
    """SHA-256 of all components by part, entry and position, as decimal numbers with commas between."""
    return hashlib.sha256(",".join(map(str, book.ravel().tolist())).encode()).hexdigest()


def with_label_error(coded: DataFrame) -> DataFrame:
    """``coded`` with ``label_error``, the sum of ``error`` over its label; rows of null label are one group.

    The sums are combined map-side and joined back, so a label of very many rows never meets in one task.
    """
    stored = cut(coded, "vector-codes")
    label, total = free_name(coded, "label_of_sum"), "label_error"
    sums = stored.groupBy("label").agg(F.sum("error").alias(total)).withColumnRenamed("label", label)
    return stored.join(sums, F.col("label").eqNullSafe(F.col(label)), "left").drop(label)


def oracle_sql() -> str:
    """The contract's columns in DuckDB SQL, one set of common table expressions a round."""
    k, n = PARTS, ENTRIES
    rounds = []
    for r in range(ROUNDS + 1):
        rounds.append(f"""
d{r} AS (SELECT v, part, entry, sum((x - y) * (x - y))::BIGINT AS dist FROM comp JOIN book{r} USING (part, pos) GROUP BY ALL),
a{r} AS MATERIALIZED (SELECT v, part, entry, dist FROM d{r} QUALIFY row_number() OVER (PARTITION BY v, part ORDER BY dist, entry) = 1)""")
        if r < ROUNDS:
            rounds.append(f"""
m{r} AS (SELECT part, entry, pos, sum(x)::BIGINT AS s, count(*) AS c FROM a{r} JOIN comp USING (v, part) GROUP BY ALL),
book{r + 1} AS MATERIALIZED (SELECT part, entry, pos,
    CASE WHEN c IS NULL THEN y ELSE ((s - ((s % c) + c) % c) // c)::BIGINT END AS y
    FROM book{r} LEFT JOIN m{r} USING (part, entry, pos))""")
    return f"""
WITH kept AS (SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) - 1 AS v, vec_id, label, embedding
    FROM embeddings WHERE embedding IS NOT NULL
      AND list_count(embedding) = len(embedding) AND len(list_filter(embedding, lambda x: isfinite(x))) = len(embedding)),
flat AS (SELECT v, unnest(embedding) AS f, generate_subscripts(embedding, 1) - 1 AS i, len(embedding) // {k} AS w FROM kept),
comp AS MATERIALIZED (SELECT v, (i // w)::INT AS part, (i % w)::INT AS pos, floor({SCALE} * f::DOUBLE)::BIGINT AS x FROM flat),
book0 AS MATERIALIZED (SELECT part, v AS entry, pos, x AS y FROM comp WHERE v < {n}),{','.join(rounds)},
whole AS (SELECT v, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, sum(dist)::BIGINT AS error
          FROM a{ROUNDS} GROUP BY v),
sha AS (SELECT sha256(string_agg(y::VARCHAR, ',' ORDER BY part, entry, pos)) AS codebooks_sha256 FROM book{ROUNDS})
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
FROM whole JOIN kept USING (v), sha
"""
