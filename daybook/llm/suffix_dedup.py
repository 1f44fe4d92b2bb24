"""Repeated byte strings by a sparse suffix array, removed wherever they occur.

Of all suffixes only those are kept that start at an anchor: a position whose
``LEAD`` leading bytes hash lowest among all positions of some string of
``LENGTH`` bytes. Equal strings have equal anchors, so no repeat is missed, and
one position in about seventy is left. Suffixes are range-partitioned by their
leading bytes between sampled splitters, sorted within each bucket, and compared
with the suffixes that lead alike: over every string of ``LENGTH`` bytes around
the anchor, to both sides.

A first pass counts leads and whole contexts, which settles most anchors: a lead
seen once repeats nothing, a context seen twice repeats everywhere. Bytes are
moved only for leads with several contexts, one row for each context. A lead with
more contexts than ``CROWDED`` is split by its strings instead of being sorted in
one task.

Defined results: a null text is empty; texts shorter than ``LENGTH`` bytes keep
everything; matches never cross rows; repeated rows repeat each other.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.llm.bits import may_hold, table_of
from daybook.llm.common import bind, unused, written
from daybook.llm.shingles import SLICE, buffers, mixed, slices

LENGTH, LEAD = 200, 64
#: Starts of a string of LENGTH bytes that may hold an anchor.
REACH = LENGTH - LEAD
#: Bytes of an anchor's context, and strings of LENGTH bytes in it.
CONTEXT, STRINGS = REACH + LENGTH, REACH + 1
#: Contexts of one lead that are compared in one task.
CROWDED = 50_000
#: Bytes of a text whose contexts are cut together.
PIECE = 1 << 20
#: Slots of the bit table that thins out the second scan; 2 MB, whatever the input.
BIT_SLOTS = 1 << 24

_STEP = np.uint64(0x9E3779B97F4A7C15)
_BACK = np.uint64(pow(int(_STEP), -1, 2**64))
_VALUES = np.random.default_rng(20240301).integers(1, 2**63, 256, dtype=np.uint64)


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(max(1, n), base, np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def _sliding(x: np.ndarray, width: int, pick) -> np.ndarray:
    """``pick`` (minimum or maximum) of every ``width`` neighbours."""
    done = 1
    while 2 * done <= width:
        x = pick(x[:-done], x[done:])
        done *= 2
    rest = width - done
    return pick(x[: len(x) - rest], x[rest:]) if rest else x


def anchors(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Positions, lead hashes and context hashes of the anchors of one text."""
    n = len(data)
    if n < LENGTH:
        none = np.empty(0, np.uint64)
        return np.empty(0, np.int64), none, none
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_VALUES[data] * _powers(_STEP, n), dtype=np.uint64)])
    back = _powers(_BACK, n)
    lead = mixed((sums[LEAD:] - sums[:-LEAD]) * back[: n - LEAD + 1])
    least = _sliding(lead, STRINGS, np.minimum)  # of each string of LENGTH bytes
    around = np.concatenate([np.zeros(REACH, np.uint64), least, np.zeros(REACH, np.uint64)])
    at = np.flatnonzero(_sliding(around, STRINGS, np.maximum) == lead)
    low, high = np.maximum(at - REACH, 0), np.minimum(at + LENGTH, n)
    context = (sums[high] - sums[low]) * back[low]
    edges = ((at - low).astype(np.uint64) << np.uint64(10)) | (high - at).astype(np.uint64)
    return at, lead[at], mixed(context ^ mixed(edges + _STEP))


def _signed(x: np.ndarray) -> pa.Array:
    return pa.array(x.astype(np.uint64).view(np.int64))


def _each_text(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray]]:
    at, data = buffers(batch.column(0))
    for first, last in slices(at, SLICE):
        for i in range(first, last):
            yield i, data[at[i] : at[i + 1]]


def _leads(texts: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [anchors(data)[1:] for _, data in _each_text(batch)]
            found = found or [(np.empty(0, np.uint64),) * 2]
            lead, context = (np.concatenate([f[k] for f in found]) for k in (0, 1))
            yield pa.RecordBatch.from_arrays([_signed(lead), _signed(context)], ["lead", "context"])

    return texts.select("text").mapInArrow(run, "lead long, context long")


def _table(keys: DataFrame, key: str) -> np.ndarray:
    """A bit for every slot that a value of ``key`` falls on; its size is fixed."""
    slot = F.pmod(F.col(key), F.lit(BIT_SLOTS))
    found = keys.groupBy(F.floor(slot / 32).cast("int").alias("at")).agg(
        F.bit_or(F.expr(f"shiftleft(1L, int(pmod({key}, 32)))")).alias("bits")
    )
    out = np.zeros(BIT_SLOTS // 32, np.uint32)
    for row in found.toLocalIterator():
        out[row["at"]] = row["bits"]
    return out


def _holds(table: np.ndarray, keys: np.ndarray) -> np.ndarray:
    slot = (keys & np.uint64(32 * len(table) - 1)).astype(np.int64)
    return (table[slot >> 5] >> (slot & 31).astype(np.uint32) & 1).astype(bool)


def _repeated_anchors(texts: DataFrame, leads: DataFrame) -> DataFrame:
    """(text_key, at, lead, context) of anchors whose lead may occur again."""
    shared = texts.sparkSession.sparkContext.broadcast(_table(leads, "lead"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = np.asarray(batch.column(1))
            parts = []
            for i, data in _each_text(batch):
                at, lead, context = anchors(data)
                keep = _holds(shared.value, lead)
                parts.append((np.full(int(keep.sum()), keys[i]), at[keep], lead[keep], context[keep]))
            parts = parts or [(np.empty(0, np.int64),) * 2 + (np.empty(0, np.uint64),) * 2]
            key, at, lead, context = (np.concatenate([p[k] for p in parts]) for k in range(4))
            yield pa.RecordBatch.from_arrays(
                [pa.array(key), pa.array(at.astype(np.int32)), _signed(lead), _signed(context)],
                ["text_key", "at", "lead", "context"],
            )

    return texts.select("text", "text_key").mapInArrow(run, "text_key long, at int, lead long, context long")


def _context_bytes(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """(lead, context, kinds, bytes, left, right) of the ``wanted`` contexts, each cut at its one place.

    ``bytes`` are CONTEXT long, the anchor at REACH; left and right are how many of
    them exist before and from the anchor.
    """
    # The places of a very long text are dealt with in pieces, so that no row grows with it.
    places = wanted.groupBy("text_key", F.floor(F.col("at") / PIECE)).agg(
        F.collect_list(F.struct("lead", "context", "kinds", "at")).alias("places")
    )
    once = texts.groupBy("text_key").agg(F.first("text").alias("text"))

    def cut(body: Column, spot: Column) -> Column:
        left = F.least(spot["at"], F.lit(REACH))
        inner = F.substring(body, spot["at"] - left + 1, left + F.lit(LENGTH))
        right = F.length(inner) - left
        padded = F.rpad(F.lpad(inner, F.lit(REACH) + right, F.lit(b"\0")), F.lit(CONTEXT), F.lit(b"\0"))
        return F.struct(*[spot[c].alias(c) for c in ("lead", "context", "kinds")], padded.alias("bytes"), left.alias("left"), right.alias("right"))

    # The bytes of a text are made once, not once for each of its places.
    body = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    cuts = bind(body, lambda b: F.transform("places", lambda spot: cut(b, spot)))
    # Both sides grow with the input, so both are moved.
    return once.join(places.hint("merge"), "text_key").select(F.explode(cuts).alias("cut")).select("cut.*")


def _string_keys(lead: np.ndarray, body: np.ndarray, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each of the STRINGS strings of each context, the one j bytes before the anchor at j; whether it exists."""
    n = len(lead)
    sums = np.zeros((n, CONTEXT + 1), np.uint64)
    np.cumsum(_VALUES[body] * _powers(_STEP, CONTEXT), axis=1, dtype=np.uint64, out=sums[:, 1:])
    j = np.arange(STRINGS)
    keys = (sums[:, CONTEXT - j] - sums[:, REACH - j]) * _powers(_BACK, CONTEXT)[REACH - j]
    keys = mixed(keys + mixed(lead)[:, None] + (j.astype(np.uint64) * _VALUES[1])[None, :])
    exists = (j[None, :] <= left[:, None]) & (LENGTH - j[None, :] <= right[:, None])
    return keys, exists


def _rolled_keys(lead: np.ndarray, body: np.ndarray) -> Iterator[np.ndarray]:
    """Hash of the string j bytes before the anchor of each context, for one j after the other.

    Held at a time are the bytes and one hash of each context, however many share a lead.
    """
    columns = np.ascontiguousarray(body.T)
    last = _powers(_STEP, LENGTH)[-1]
    own, keys = mixed(lead), np.zeros(len(lead), np.uint64)
    for i in reversed(range(REACH, CONTEXT)):
        keys = keys * _STEP + _VALUES[columns[i]]
    for j in range(STRINGS):
        yield mixed(keys + own)
        if j < REACH:
            keys = (keys - _VALUES[columns[CONTEXT - 1 - j]] * last) * _STEP + _VALUES[columns[REACH - 1 - j]]


def _columns(batch: pa.RecordBatch) -> tuple[np.ndarray, ...]:
    lead, context, left, right = (np.asarray(batch.column(batch.schema.names.index(c))) for c in ("lead", "context", "left", "right"))
    raw = b"".join(batch.column(batch.schema.names.index("bytes")).to_pylist())
    body = np.frombuffer(raw, np.uint8).reshape(-1, CONTEXT)
    return lead.view(np.uint64), context, body, left, right


def _compared(parts: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
    """(lead, context, mask) of the contexts in ``parts`` of which some string occurs again in them."""
    lead, context, body, left, right = (np.concatenate([p[k] for p in parts]) for k in range(5))
    twice = np.zeros((len(lead), STRINGS), bool)
    for j, keys in enumerate(_rolled_keys(lead, body)):
        rows = np.flatnonzero((left >= j) & (right >= LENGTH - j))
        _, back, counts = np.unique(keys[rows], return_inverse=True, return_counts=True)
        twice[rows, j] = counts[back] > 1
    some = twice.any(axis=1)
    masks = [m.tobytes() for m in np.packbits(twice[some], axis=1)]
    return pa.RecordBatch.from_arrays(
        [_signed(lead[some]), pa.array(context[some]), pa.array(masks, pa.binary())], ["lead", "context", "mask"]
    )


def _masks(contexts: DataFrame) -> DataFrame:
    """(lead, context, mask): which strings of a context some other context of the lead holds.

    Buckets between sampled splitters, each sorted by lead; a group of equal leads
    never crosses a boundary.
    """
    # Leads are hashes of leading bytes: their order deals equal beginnings to one bucket.
    sorted_ = contexts.repartitionByRange("lead").sortWithinPartitions("lead").select("lead", "context", "bytes", "left", "right")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        for batch in batches:
            for first in range(0, batch.num_rows, 2000):
                part = _columns(batch.slice(first, 2000))
                # What came before is done unless its last lead goes on.
                if held and held[-1][0][-1] != part[0][0]:
                    yield _compared(held)
                    held = []
                inner = np.flatnonzero(part[0][1:] != part[0][:-1])
                if len(inner):
                    cut = int(inner[-1]) + 1
                    yield _compared([*held, tuple(x[:cut] for x in part)])
                    held = [tuple(x[cut:] for x in part)]
                else:
                    held.append(part)
        if held:
            yield _compared(held)

    return sorted_.mapInArrow(run, "lead long, context long, mask binary")


def _crowded_masks(contexts: DataFrame) -> DataFrame:
    """As ``_masks``, for leads with very many contexts: every string is a row of its own."""

    def explode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, 2000):
                lead, context, body, left, right = _columns(batch.slice(first, 2000))
                keys, exists = _string_keys(lead, body, left, right)
                row, j = np.nonzero(exists)
                yield pa.RecordBatch.from_arrays(
                    [_signed(lead[row]), pa.array(context[row]), pa.array(j.astype(np.int32)), _signed(keys[row, j])],
                    ["lead", "context", "j", "string"],
                )

    fields = ("lead", "context", "bytes", "left", "right")
    strings = written(contexts.select(*fields).mapInArrow(explode, "lead long, context long, j int, string long"), "strings")
    twice = strings.groupBy("string").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("string")
    # Three numbers hold the bits in the order in which packed masks hold them.
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.lit(63) - F.col("j") % 64)
    words = [F.bit_or(F.when(F.floor(F.col("j") / 64) == k, bit).otherwise(F.lit(0).cast("long"))) for k in range(-(-STRINGS // 64))]
    found = strings.join(twice, "string").groupBy("lead", "context").agg(*[w.alias(f"w{k}") for k, w in enumerate(words)])
    hexes = F.concat(*[F.lpad(F.hex(f"w{k}"), 16, "0") for k in range(len(words))])
    return found.select("lead", "context", F.unhex(F.substring(hexes, 1, 2 * -(-STRINGS // 8))).alias("mask"))


def repeated_spots(docs: DataFrame, text: str = "text") -> DataFrame:
    """(text_key, spots): the anchors of a text around which strings repeat, as array of (at, mask).

    A null mask stands for all strings around the anchor.
    """
    texts = docs.select(F.col(f"`{text}`").alias("text"), F.xxhash64(f"`{text}`").alias("text_key"))
    leads = written(
        _leads(texts)
        .groupBy("lead")
        .agg(F.count(F.lit(1)).alias("n"), F.min("context").alias("x"), F.max("context").alias("y"))
        .where("n > 1")
        .select("lead", (F.col("x") != F.col("y")).alias("several")),
        "leads",
    )
    spots = written(_repeated_anchors(texts, leads).join(leads, "lead"), "anchors")
    contexts = written(
        spots.groupBy("lead", "context", "several")
        .agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("text_key", "at")).alias("first")),
        "contexts",
    )
    # One place stands for each context of a lead that has several.
    wanted = contexts.where("several").select("lead", "context", "first.*")
    sizes = wanted.groupBy("lead").agg(F.count(F.lit(1)).alias("kinds"))
    found = written(_context_bytes(texts, wanted.join(sizes, "lead")), "bytes")
    masks = _masks(found.where(F.col("kinds") <= CROWDED)).unionByName(_crowded_masks(found.where(F.col("kinds") > CROWDED)))
    status = (
        contexts.select("lead", "context", (F.col("n") > 1).alias("all"))
        .join(masks, ["lead", "context"], "left")
        .where("all or mask is not null")
        .select("lead", "context", F.when(~F.col("all"), F.col("mask")).alias("mask"))
    )
    return (
        spots.select("text_key", "at", "lead", "context")
        .distinct()
        .join(status, ["lead", "context"])
        .groupBy("text_key")
        .agg(F.collect_list(F.struct("at", "mask")).alias("spots"))
    )


def covered(length: int, spots: list[dict]) -> np.ndarray:
    """Which bytes of a text lie in a repeated string."""
    edges = np.zeros(length + 1, np.int64)
    for spot in spots:
        at, mask = spot["at"], spot["mask"]
        if mask is None:
            j = np.arange(max(0, LENGTH - (length - at)), min(at, REACH) + 1)
        else:
            j = np.flatnonzero(np.unpackbits(np.frombuffer(mask, np.uint8))[:STRINGS])
        np.add.at(edges, at - j, 1)
        np.add.at(edges, at - j + LENGTH, -1)
    return np.cumsum(edges)[:length] > 0


def _remaining(data: bytes, spots: list[dict] | None) -> tuple[bytes, int, int]:
    """What is left of a text, how many bytes and runs went."""
    if not spots:
        return data, 0, 0
    gone = covered(len(data), spots)
    runs = int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum())
    return np.frombuffer(data, np.uint8)[~gone].tobytes(), int(gone.sum()), runs


def without_repeats(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with kept (the remaining bytes), n_bytes, n_removed and n_spans; such columns give way.

    Only texts with a repeat are moved; the others are cleared by a bit table where they are.
    """
    docs = docs.drop("kept", "n_bytes", "n_removed", "n_spans")
    found = written(repeated_spots(docs, text), "spots")
    key, spots = F.xxhash64(f"`{text}`"), unused(docs, "_spots")
    maybe = may_hold(table_of(found, "text_key"), key)
    matched = found.select(F.col("text_key").alias("_text_key"), F.col("spots").alias(spots))
    # Spots grow with the input, so both sides are moved.
    hit = docs.where(maybe).join(matched.hint("merge"), key == F.col("_text_key"), "left").drop("_text_key")
    body = F.coalesce(F.col(f"`{text}`"), F.lit("")).cast("binary")
    names = [f"`{c}`" for c in docs.columns]
    zero = F.lit(0).cast("long")
    clear = docs.where(~maybe).select(
        *names, body.alias("kept"), F.length(body).cast("long").alias("n_bytes"), zero.alias("n_removed"), zero.alias("n_spans")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = np.concatenate([np.zeros(1, np.int64), np.cumsum(pc.fill_null(pc.binary_length(batch.column(0)), 0))])
            # Spots are Python objects while they are looked at: those of a slice at a time.
            for first, last in slices(at, SLICE):
                part = batch.slice(first, last - first)
                raw = [x or b"" for x in part.column(0).to_pylist()]
                out = [_remaining(x, s) for x, s in zip(raw, part.column(1).to_pylist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        *part.columns[2:],
                        pa.array([o[0] for o in out], pa.binary()),
                        pa.array([len(x) for x in raw], pa.int64()),
                        *[pa.array([o[k] for o in out], pa.int64()) for k in (1, 2)],
                    ],
                    [*part.schema.names[2:], "kept", "n_bytes", "n_removed", "n_spans"],
                )

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema.fields)
    moved = hit.select(body.alias("_body"), spots, *names).mapInArrow(
        run, f"{fields}, kept binary, n_bytes long, n_removed long, n_spans long"
    )
    return clear.unionByName(moved)


def digest(docs: DataFrame) -> DataFrame:
    out = without_repeats(docs.select("doc_id", "text"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def sha256(data: bytes) -> str:
    return hashlib.sha256(data).hexdigest()
