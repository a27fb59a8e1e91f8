"""Best-fit packing of tokenised documents into sequences of fixed capacity.

Method: linear grouping. Lengths above capacity/8 are sorted and dealt into groups of equal cardinality, each rounded up to
its largest length; configurations over these few sizes are filled as full as a knapsack allows, largest size first; actual
lengths then take the places of the rounded ones, and the small documents go best-fit into the room that is left. This is
done for a few numbers of groups, up to one group a length (then nothing is rounded), and the plan with the fewest sequences
is taken.

All planning is done on the histogram of lengths, which has at most `capacity` entries whatever the corpus holds. The
documents themselves are only ranked within their length (salted, so that a length that a third of all rows share is many
groups) and look their place up in the plan.

Null text is an empty document, which is its end token alone; null or repeated doc_ids are packed like others, a row each;
an empty table gives an empty result; columns other than id and text are ignored."""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import map_rows, materialise
from .tokens import FlatEncoder, tokenizer_path

#: Numbers of groups that are tried besides one a length.
GROUPS = (128, 512, 2048)
PIECE_SCHEMA = "doc_id long, piece int, start long, length long, ids_crc32 long"


def token_pieces(docs: DataFrame, tokenizer: str | None = None, capacity: int = 1024, end_id: int = 2, id_col: str = "doc_id", text_col: str = "text", keep_ids: bool = False) -> DataFrame:
    """A row per piece of at most `capacity` tokens: PIECE_SCHEMA, and with keep_ids the ids as little-endian bytes. Of a
    document that is cut, the first piece is the one that may be shorter."""
    path = tokenizer or tokenizer_path()
    arrow = pa.schema([("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("ids_crc32", pa.int64())] + [("ids", pa.binary())] * keep_ids)
    end = int(end_id).to_bytes(4, "little")

    def make():
        encode = FlatEncoder(path).encode

        def work(batch: pa.RecordBatch) -> dict:
            out = {f.name: [] for f in arrow}
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = encode(text or "") + end
                n = len(ids) // 4
                at, size = 0, (n - 1) % capacity + 1
                for piece in range(-(-n // capacity)):
                    part = ids[4 * at : 4 * (at + size)]
                    for key, x in zip(out, (doc_id, piece, at, size, zlib.crc32(part), part), strict=False):
                        out[key].append(x)
                    at, size = at + size, capacity
            return out

        return work

    return map_rows(docs.select(F.col(id_col).cast("long"), F.col(text_col)), make, PIECE_SCHEMA + ", ids binary" * keep_ids, arrow)


def _groups(hist: dict[int, int], groups: int) -> list[list[list[int]]]:
    """Runs [length, count] from long to short, dealt into at most `groups` groups of equal cardinality."""
    total = sum(hist.values())
    each, out, room = -(-total // max(1, groups)), [], 0
    for length in sorted(hist, reverse=True):
        left = hist[length]
        while left:
            if not room:
                out.append([])
                room = each
            if not out[-1] and left >= each:  # a length that fills whole groups stays exact
                take = left
                room = take
            else:
                take = min(left, room)
            out[-1].append([length, take])
            room, left = room - take, left - take
    return out


def _fullest(space: int, sizes: list[int], counts: list[int]) -> list[int]:
    """How many of each size (descending) fill `space` best, each at most counts times; the larger ones are preferred."""
    mask = (1 << (space + 1)) - 1
    reach = [1]
    for s, c in zip(reversed(sizes), reversed(counts), strict=True):
        now = reach[-1]
        for _ in range(min(c, space // s)):
            step = (now | now << s) & mask
            if step == now:
                break
            now = step
        reach.append(now)
    at, out = reach[-1].bit_length() - 1, []
    for i, s in enumerate(sizes):
        below, n = reach[len(sizes) - 1 - i], 0
        most = min(counts[i], at // s)
        for k in range(most, -1, -1):
            if below >> (at - k * s) & 1:
                n = k
                break
        out.append(n)
        at -= n * s
    return out


def plan(hist: dict[int, int], capacity: int = 1024, groups: tuple[int, ...] = GROUPS) -> list[tuple[int, list[tuple[int, int]]]]:
    """The tightest of the plans for these numbers of groups and for groups of single lengths; of equal ones the first."""
    plans = [_plan(hist, capacity, g) for g in (*groups, sum(hist.values()))]
    return min(plans, key=lambda patterns: sum(times for times, _ in patterns))


def _plan(hist: dict[int, int], capacity: int, groups: int) -> list[tuple[int, list[tuple[int, int]]]]:
    """Patterns (number of sequences, [(length, count in each)]) that hold every entry of the histogram exactly once."""
    large = {s: n for s, n in hist.items() if s > capacity // 8}
    dealt = _groups(large, groups)
    sizes, left = [g[0][0] for g in dealt], [sum(n for _, n in g) for g in dealt]
    merged: dict[int, list[list[int]]] = {}
    for size, g in zip(sizes, dealt, strict=True):
        merged.setdefault(size, []).extend(g)
    sizes = sorted(merged, reverse=True)
    left = [sum(n for _, n in merged[s]) for s in sizes]
    # 1. configurations over the rounded sizes
    configs = []
    for first in range(len(sizes)):
        while left[first]:
            rest = left[first:]
            rest[0] -= 1
            fill = _fullest(capacity - sizes[first], sizes[first:], rest)
            fill[0] += 1
            times = min(n // c for n, c in zip(left[first:], fill, strict=True) if c)
            for i, c in enumerate(fill):
                left[first + i] -= c * times
            configs.append((times, {sizes[first + i]: c for i, c in enumerate(fill) if c}))
    # 2. actual lengths take the places of the rounded ones; a configuration is split where a run of equal lengths ends
    runs = {s: [list(x) for x in merged[s]] for s in sizes}
    bins: list[list] = []  # [times, residual, [(length, count)]]
    for times, config in configs:
        taken, cuts = {}, {0, times}
        for s, c in config.items():
            need, own, at = c * times, [], 0
            while need:
                run = runs[s][0]
                k = min(run[1], need)
                own.append((at, run[0]))
                at, need, run[1] = at + k, need - k, run[1] - k
                cuts |= {x for x in (at // c, -(-at // c)) if x <= times}
                if not run[1]:
                    runs[s].pop(0)
            taken[s] = own
        marks = sorted(cuts)
        for lo, hi in zip(marks, marks[1:], strict=False):
            content: dict[int, int] = defaultdict(int)
            for s, c in config.items():
                starts = [x[0] for x in taken[s]]
                if hi - lo == 1:
                    for j in range(lo * c, hi * c):
                        content[taken[s][bisect_right(starts, j) - 1][1]] += 1
                else:
                    content[taken[s][bisect_right(starts, lo * c) - 1][1]] += c
            bins.append([hi - lo, capacity - sum(k * n for k, n in content.items()), sorted(content.items(), reverse=True)])
    # 3. small lengths, best fit: the tightest room first
    room: dict[int, list[list]] = defaultdict(list)
    for b in bins:
        room[b[1]].append(b)
    for s in sorted((s for s in hist if s <= capacity // 8), reverse=True):
        n = hist[s]
        for r in [r for r in sorted(room) if r >= s]:
            while n and room[r]:
                b = room[r].pop()
                q = r // s
                full = min(b[0], n // q)
                parts = [(full, q)] if full else []
                if full < b[0] and n - full * q:
                    parts.append((1, n - full * q))
                if (spare := b[0] - sum(t for t, _ in parts)) > 0:
                    room[r].append([spare, r, b[2]])
                for t, k in parts:
                    room[r - k * s].append([t, r - k * s, [*b[2], (s, k)]])
                    n -= t * k
            if not n:
                break
        while n:
            q = min(n, capacity // s)
            t = n // q
            room[capacity - q * s].append([t, capacity - q * s, [(s, q)]])
            n -= t * q
    return [(b[0], b[2]) for r in sorted(room) for b in room[r]]


def _slots(patterns: list[tuple[int, list[tuple[int, int]]]]) -> np.ndarray:
    """Rows (length, first rank, first sequence, pieces of this length in each sequence, offset of the first of them)."""
    used: dict[int, int] = defaultdict(int)
    rows, base = [], 0
    for times, content in patterns:
        offset = 0
        for length, c in content:
            rows.append((length, used[length], base, c, offset))
            used[length] += c * times
            offset += length * c
        base += times
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


def assign_sequences(pieces: DataFrame, capacity: int = 1024, groups: tuple[int, ...] = GROUPS, rows_per_salt: int = 50_000) -> DataFrame:
    """Adds sequence_id and offset to rows that have `length` (1 to capacity). `pieces` is read several times, and rows are
    salted by their number within the task, which deals equal rows out too, so it must be a stored table. Only the histogram of lengths (at most `capacity` rows) comes to the driver."""
    hist = {r[0]: r[1] for r in pieces.groupBy("length").count().collect()}
    slots = _slots(plan(hist, capacity, groups))
    n_salts = max(64, -(-sum(hist.values()) // rows_per_salt))
    names = pieces.columns
    salted = pieces.withColumn("_salt", F.pmod(F.monotonically_increasing_id(), F.lit(n_salts)).cast("int"))
    # rank within a length: place within the salt, and the rows of the salts before
    before = Window.partitionBy("length").orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    starts = salted.groupBy("length", "_salt").agg(F.count("*").alias("_n")).select("length", "_salt", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    place = Window.partitionBy("length", "_salt").orderBy(*[F.col(c) for c in names])
    ranked = salted.withColumn("_in", F.row_number().over(place)).join(starts, ["length", "_salt"]).select(*names, (F.col("_before") + F.col("_in") - 1).alias("_rank"))
    kept = [f for f in pieces.schema.fields]
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept) + ", sequence_id long, offset long"

    def place_them(batches):
        first = slots[:, 0] * 2**40 + slots[:, 1] if len(slots) else np.empty(0, np.int64)
        for batch in batches:
            length = batch.column(batch.schema.get_field_index("length")).to_numpy(zero_copy_only=False).astype(np.int64)
            rank = batch.column(batch.num_columns - 1).to_numpy(zero_copy_only=False).astype(np.int64)
            s = slots[np.searchsorted(first, length * 2**40 + rank, "right") - 1]
            k = rank - s[:, 1]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(s[:, 2] + k // s[:, 3]), pa.array(s[:, 4] + k % s[:, 3] * length)], names=[*names, "sequence_id", "offset"])

    return ranked.mapInArrow(place_them, schema)


def pack(docs: DataFrame, tokenizer: str | None = None, capacity: int = 1024, end_id: int = 2, groups: tuple[int, ...] = GROUPS) -> DataFrame:
    """Places of all pieces: PIECE_SCHEMA, sequence_id, offset."""
    return assign_sequences(materialise(token_pieces(docs, tokenizer, capacity, end_id), "pieces"), capacity, groups)


def sequences(docs: DataFrame, tokenizer: str | None = None, capacity: int = 1024, end_id: int = 2, groups: tuple[int, ...] = GROUPS) -> DataFrame:
    """The packed sequences themselves: sequence_id, doc_ids and token ids (little-endian unsigned 32-bit) in order. A group
    holds at most `capacity` tokens. Rows are treated as in pack(): null text is an end token, an empty table gives no sequences,
    and documents with null or repeated ids are in it each."""
    stored = materialise(token_pieces(docs, tokenizer, capacity, end_id, keep_ids=True), "pieces")
    placed = assign_sequences(stored, capacity, groups)
    parts = F.array_sort(F.collect_list(F.struct("offset", "doc_id", "ids")))
    return placed.groupBy("sequence_id").agg(parts.alias("p")).select(
        "sequence_id", F.col("p.doc_id").alias("doc_ids"), F.aggregate("p", F.lit(b""), lambda a, x: F.concat(a, x["ids"])).alias("ids"))
