"""Removal of long repeats through sorted suffixes.

A byte goes if a string of ``LENGTH`` bytes that covers it starts anywhere else,
too, in the same text or another. All suffixes of a corpus are too many to
move, so they are dealt to buckets that equal strings share: in every window of
``LENGTH`` bytes the least ``GRAM``-gram by hash, the leftmost of equals, is its
anchor, and equal windows have equal anchors at equal places. A run of windows
with one anchor is its context.

1. Anchors whose gram occurs once in the corpus are dropped: none of their
   windows repeats.
2. Contexts that are equal as a whole repeat as a whole; one of each kind goes on
   to be compared with the others of its gram.
3. A window has, beside its gram, one of two parts in whole: all that windows with an anchor in
   their first half, or in their second, have in common. Each context is split there, and a part goes
   on only if its common bytes, the core, occur in another part that is not equal to it as a whole. Equal
   parts repeat as a whole, and one of each kind goes on. Every text takes this step, at every size.
4. The windows of one core are suffixes to sort, to a depth of ``LENGTH``: multikey
   quicksort by words of eight bytes down to ``SHALLOW``, then blind tries, which
   compare a group with one member only, and split it by the length of the common
   prefix and the byte behind it. Suffixes that reach ``LENGTH`` together repeat.
   A core of more than ``MEMBERS`` parts is first split once more, as in 3, and so on: each split halves the
   windows of a part and lengthens its core, and parts of one window are equal or apart. So no task holds
   a large group, and each context takes at most two parts per place where it differs from others, and split.

Counts are combined before they move; joins on grams and cores stand between plain shuffles, so that Spark can
split one in a third of all texts. Cores are compared by 64 bits, where a false match only sorts more,
whole parts by 128 bits, whole contexts of one gram by 64. A text's contexts are one list in its row, so
it grows with the longest text.

Null text counts as empty; texts shorter than ``LENGTH`` stay whole, and an empty
table gives no rows. Equal rows are texts of their own, and so repeat each other.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from functools import reduce
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import drop, mixed, powers, prefix_sums, saved, signed, slices, text_bytes
from .jaccard import row_key

LENGTH = 400
GRAM = 48
SHALLOW = 32
#: Different parts with one core beyond which they are split once more before they are sorted.
MEMBERS = 1000
#: Windows of a context, by the distance from their start to the anchor, are 0 to ``LENGTH - GRAM``; that
#: many halvings leave one. The first split is in the middle.
SPLITS = (LENGTH - GRAM).bit_length()
MARGIN = (2**SPLITS - (LENGTH - GRAM + 1)) // 2
#: Bytes of a text in which anchors are looked for at once.
SEGMENT = 8_000_000
#: Windows sorted at once in a task, if they belong to several cores.
WINDOWS = 400_000


# --- anchors ----------------------------------------------------------------------


def anchors(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """Runs of windows with one anchor: anchor, first and last window, and gram hash."""
    n = len(data)
    if n > 2 * SEGMENT:  # a long text comes alone
        parts = []
        for a in range(0, n - LENGTH + 1, SEGMENT):
            piece = data[a : a + SEGMENT + LENGTH - 1]
            x, lo, hi, h = anchors(piece, np.array([0, len(piece)]))
            parts.append((x + a, lo + a, hi + a, h))
        return tuple(np.concatenate(p) for p in zip(*parts, strict=True))
    width, starts = LENGTH - GRAM + 1, n - LENGTH + 1
    if starts <= 0:
        none = np.zeros(0, np.int64)
        return none, none, none, none.astype(np.uint64)
    sums = prefix_sums(data)
    grams = mixed((sums[GRAM:] - sums[:-GRAM]) * powers(n + 1)[1][: n - GRAM + 1])
    # The place in the low bits makes the least key the leftmost least gram.
    m = len(grams)
    blocks = -(-m // width)
    key = np.full(blocks * width, np.iinfo(np.uint64).max, np.uint64)
    np.bitwise_and(grams, np.uint64(0xFFFFFFFFFF000000), out=key[:m])
    key[:m] |= np.arange(m, dtype=np.uint64)
    key = key.reshape(blocks, width)
    # the least of a window: behind its first place in that block, before its last in the next
    ahead = np.minimum.accumulate(key, axis=1).reshape(-1)
    behind = np.minimum.accumulate(key[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    least = np.minimum(behind[:starts], ahead[width - 1 : width - 1 + starts])
    place = (least & np.uint64(0xFFFFFF)).astype(np.int64)
    size = np.diff(offsets)
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, offsets[:-1][size >= LENGTH], 1)
    np.add.at(edge, offsets[1:][size >= LENGTH] - LENGTH + 1, -1)
    whole = np.cumsum(edge)[:starts] > 0  # the window lies in one text
    first, last = whole.copy(), whole.copy()
    change = place[1:] != place[:-1]
    first[1:] &= change | ~whole[:-1]
    last[:-1] &= change | ~whole[1:]
    lo = np.flatnonzero(first)
    return place[lo], lo, np.flatnonzero(last), grams[place[lo]]


def _gram_counts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text"):
        *_, h = anchors(*text_bytes(batch.column("text")))
        gram, n = np.unique(signed(h), return_counts=True)
        yield pa.record_batch([pa.array(gram), pa.array(n.astype(np.int64))], names=["gram", "n"])


_CONTEXT = "key binary, gram bigint, content bigint, first int, windows int, anchor int"


def _contexts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text"):
        data, offsets = text_bytes(batch.column("text"))
        x, lo, hi, h = anchors(data, offsets)
        row = np.searchsorted(offsets, lo, "right") - 1
        view = memoryview(np.ascontiguousarray(data))
        digest = b"".join(
            hashlib.blake2b(view[a:b], digest_size=8).digest()
            for a, b in zip(lo.tolist(), (hi + LENGTH).tolist(), strict=True)
        )
        yield pa.record_batch(
            [
                batch.column("key").take(pa.array(row)),
                pa.array(signed(h)),
                pa.array(np.frombuffer(digest, np.int64)),
                pa.array((lo - offsets[row]).astype(np.int32)),
                pa.array((hi - lo + 1).astype(np.int32)),
                pa.array((x - lo).astype(np.int32)),
            ],
            names=["key", "gram", "content", "first", "windows", "anchor"],
        )


def repeated_contexts(rows: DataFrame) -> DataFrame:
    """For each text with a gram that occurs again, its contexts; written.

    ``key, contexts``: of each ``first``, ``windows``, ``anchor``, whether it
    occurs again as a whole (``again``), and whether to compare it (``sent``).
    """
    text = rows.select("text")
    grams = saved(
        text.mapInArrow(_gram_counts, "gram bigint, n bigint").groupBy("gram").agg(F.sum("n").alias("n"))
        .where(F.col("n") > 1).select("gram"),
        "suffix-grams", keep=False,
    )
    found = saved(rows.select("key", "text").mapInArrow(_contexts, _CONTEXT).join(grams, "gram"), "suffix-found", keep=False)
    drop(grams)
    kinds = saved(
        found.groupBy("gram", "content").agg(F.count(F.lit(1)).alias("times"), F.min(F.struct("key", "first")).alias("lead")),
        "suffix-kinds", keep=False,
    )
    rivals = saved(kinds.groupBy("gram").agg(F.count(F.lit(1)).alias("rivals")), "suffix-rivals", keep=False)
    known = saved(kinds.join(rivals, "gram"), "suffix-known", keep=False)
    drop(kinds)
    drop(rivals)
    judged = found.join(known, ["gram", "content"]).select(
        "key", "first", "windows", "anchor",
        (F.col("times") > 1).alias("again"),
        ((F.col("rivals") > 1) & (F.struct("key", "first") == F.col("lead"))).alias("sent"),
    ).where("again or sent")
    # as a set: equal rows of the table have the same key and the same contexts
    result = saved(
        judged.groupBy("key").agg(
            F.collect_set(F.struct("first", "windows", "anchor", "again", "sent")).alias("contexts")
        ),
        "suffix-texts", keep=False,
    )
    drop(found)
    drop(known)
    return result


# --- sorting ----------------------------------------------------------------------


def _eights(data: np.ndarray) -> np.ndarray:
    """The eight bytes from each place as one number that sorts like them."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    out = np.zeros(len(data), np.uint64)
    for k in range(8):
        out = out << np.uint64(8) | padded[k : k + len(data)]
    return out


def _regrouped(keep: np.ndarray, group: np.ndarray, *keys: np.ndarray):
    """Order members by group and keys, number the new groups, and leave single members out."""
    order = np.lexsort((*keys[::-1], group))
    new = np.ones(len(order), bool)
    new[1:] = group[order][1:] != group[order][:-1]
    for k in keys:
        new[1:] |= k[order][1:] != k[order][:-1]
    number = np.cumsum(new) - 1
    several = np.bincount(number)[number] > 1
    return keep[order[several]], number[several], order[several]


def repeats(data: np.ndarray, starts: np.ndarray, group: np.ndarray, length: int = LENGTH) -> np.ndarray:
    """Which suffixes share ``length`` bytes with another of their group."""
    found = np.zeros(len(starts), bool)
    eights = _eights(data)
    member, group, _ = _regrouped(np.arange(len(starts)), group)
    depth = 0
    # Multikey quicksort: order by one symbol of eight bytes, go on in the groups of equals.
    while depth < min(SHALLOW, length - 8) and len(member):
        member, group, _ = _regrouped(member, group, eights[starts[member] + depth])
        depth += 8
    known = np.full(len(member), depth)
    # Blind tries, a level for all groups at a time: what tells a member from the
    # group's first is the length of their common prefix and the byte behind it.
    while len(member):
        head = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
        pivot = starts[member[head]][np.cumsum(np.append(True, group[1:] != group[:-1])) - 1]
        here = starts[member]
        common = known.copy()
        going = np.flatnonzero(common < length)
        while len(going):
            differ = eights[here[going] + common[going]] ^ eights[pivot[going] + common[going]]
            same = differ == 0
            stop, bits = going[~same], differ[~same]
            # whole equal bytes before the first that differs
            common[stop] += 8 - np.searchsorted(_BYTE_LIMITS, bits, "right")
            common[going[same]] += 8
            going = going[same]
            going = going[common[going] < length]
        equal = common >= length
        found[member[equal]] = True
        lone = np.bincount(group, equal)[group[head]] == 1
        found[member[head[lone]]] = False  # the first is equal to itself only
        rest = np.flatnonzero(~equal)
        behind = data[here[rest] + common[rest]]
        member, group, order = _regrouped(member[rest], group[rest], common[rest], behind)
        known = common[rest][order] + 1
    return found


#: A difference below 256**k leaves at least 8 - k equal bytes.
_BYTE_LIMITS = np.array([1 << 8 * k for k in range(8)], np.uint64)


def _sorted_buckets(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Byte ranges that occur again, per text, from rows sorted by core."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in _whole_cores(batches):
        held.append(batch)
        size += int(batch.column("windows").to_numpy().sum())
        if size >= WINDOWS:
            yield from _ranges(held)
            held, size = [], 0
    if held:
        yield from _ranges(held)


def _whole_cores(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches cut so that no core lies in two."""
    rest: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        core = batch.column("core").to_numpy()
        last = int(np.searchsorted(core, core[-1], "left"))
        if last == 0 and rest and rest[-1].column("core")[-1].as_py() == core[0]:
            rest.append(batch)
            continue
        edges = np.append(np.flatnonzero(np.diff(core[:last])) + 1, last) if last else np.zeros(0, int)
        at = 0
        # groups of cores of moderate size
        for e in edges:
            if e - at >= 256 or e == last:
                piece = batch.slice(at, e - at)
                if rest:
                    if rest[-1].column("core")[-1].as_py() != core[at]:
                        yield _one(rest)
                        rest = []
                    else:
                        piece = _one([*rest, piece])
                        rest = []
                yield piece
                at = e
        if rest and rest[-1].column("core")[-1].as_py() != core[last]:
            yield _one(rest)
            rest = []
        rest.append(batch.slice(last))
    if rest:
        yield _one(rest)


def _one(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    if len(batches) == 1:
        return batches[0]
    return pa.Table.from_batches(batches).combine_chunks().to_batches()[0]


def _ranges(batches: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = _one(batches)
    data, offsets = text_bytes_of(rows.column("bytes"))
    windows = rows.column("windows").to_numpy().astype(np.int64)
    core, anchor = rows.column("core").to_numpy(), rows.column("anchor").to_numpy().astype(np.int64)
    context = np.repeat(np.arange(len(windows)), windows)
    step = np.arange(len(context)) - np.repeat(np.cumsum(windows) - windows, windows)
    starts = offsets[:-1][context] + step
    # One group per core and distance to the anchor: only such windows can be equal.
    new = np.append(True, core[1:] != core[:-1])
    group = (np.cumsum(new) - 1)[context] * (LENGTH + 1) + anchor[context] - step
    found = np.flatnonzero(repeats(data, starts, group))
    if not len(found):
        return
    first = np.append(True, (np.diff(found) > 1) | (np.diff(context[found]) > 0))
    last = np.append(first[1:], True)
    a, b = found[first], found[last]
    base = rows.column("first").to_numpy().astype(np.int64)
    which = context[a]
    own = rows.column("own").to_numpy(zero_copy_only=False)[which]
    yield pa.record_batch(
        [
            rows.column("key").take(pa.array(which[own])),
            pa.array((base[which] + step[a])[own]),
            pa.array((base[which] + step[b] + LENGTH)[own]),
        ],
        names=["key", "start", "end"],
    )


def text_bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a binary column without nulls."""
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]], at - at[0]


# --- removal ----------------------------------------------------------------------


def _cut(raw: memoryview, ranges: list[tuple[int, int]]) -> tuple[int, int, str, list[tuple[int, int]]]:
    merged: list[list[int]] = []
    for a, b in sorted(ranges):
        if merged and a <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], b)
        else:
            merged.append([a, b])
    digest, at = hashlib.sha256(), 0
    for a, b in merged:
        digest.update(raw[at:a])
        at = b
    digest.update(raw[at:])
    return sum(b - a for a, b in merged), len(merged), digest.hexdigest(), [tuple(m) for m in merged]


_RESULT = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"
_STATE = "key binary, contexts array<struct<first:int,windows:int,anchor:int,again:boolean,sent:boolean>>, text string"


def _settled(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Results of texts that nothing can change any more; others pass on with their text."""
    for batch in slices(batches, "text"):
        data, offsets = text_bytes(batch.column("text"))
        view = memoryview(np.ascontiguousarray(data))
        lists = batch.column("contexts").to_pylist()
        done, texts, contexts = [], [], []
        for i, found in enumerate(lists):
            a, b = int(offsets[i]), int(offsets[i + 1])
            open_ = any(c["sent"] and not c["again"] for c in found or ())
            sent = any(c["sent"] for c in found or ())
            ranges = [(c["first"], c["first"] + c["windows"] - 1 + LENGTH) for c in found or () if c["again"]]
            done.append((b - a, None, None, None) if open_ else (b - a, *_cut(view[a:b], ranges)[:3]))
            texts.append(sent)
            contexts.append(found if sent else None)
        keep = pa.array(texts)
        none = pa.nulls(batch.num_rows, batch.schema.field("text").type)
        yield pa.record_batch(
            [
                batch.column("doc_id"),
                *(pa.array([d[k] for d in done], t) for k, t in enumerate((pa.int64(), pa.int64(), pa.int64(), pa.string()))),
                batch.column("key"),
                pa.array(contexts, batch.schema.field("contexts").type),
                pc.if_else(keep, batch.column("text"), none),
            ],
            names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "key", "contexts", "text"],
        )


_PART = "key binary, core bigint, whole binary, first int, windows int, anchor int, own boolean"
_BYTES = "key binary, core bigint, first int, windows int, anchor int, own boolean, bytes binary"


def _parts(split: int):
    """Map function: each run of windows in the parts that ``split`` halvings of the distances to the anchor make."""
    shift = SPLITS - split

    def part(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
        for key, run, view, base in _runs(batches):
            x = base + run["first"] + run["anchor"]  # the anchor's place
            far, near = run["anchor"], run["anchor"] - run["windows"] + 1  # distances of the first and last window
            for number in range((near + MARGIN) >> shift, ((far + MARGIN) >> shift) + 1):
                least = max((number << shift) - MARGIN, 0)
                most = min(((number + 1) << shift) - 1 - MARGIN, LENGTH - GRAM)
                top, low = min(far, most), max(near, least)
                # the place beside the bytes: equal parts lie alike around their anchors
                core = hashlib.blake2b(view[x - least : x - most + LENGTH], digest_size=8, salt=b"%d" % number).digest()
                whole = hashlib.blake2b(view[x - top : x - low + LENGTH], digest_size=16, salt=b"%d" % top).digest()
                yield key, int.from_bytes(core, "little", signed=True), whole, x - top - base, top - low + 1, top, run["own"]

    kinds = (pa.binary(), pa.int64(), pa.binary(), pa.int32(), pa.int32(), pa.int32(), pa.bool_())
    return _batched(part, kinds, ["key", "core", "whole", "first", "windows", "anchor", "own"], 32_768)


def _bytes(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of the parts to sort."""

    def send(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
        for key, run, view, base in _runs(batches):
            a = base + run["first"]
            bytes_ = bytes(view[a : a + run["windows"] - 1 + LENGTH])
            yield key, run["core"], run["first"], run["windows"], run["anchor"], run["own"], bytes_

    kinds = (pa.binary(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.bool_(), pa.binary())
    return _batched(send, kinds, ["key", "core", "first", "windows", "anchor", "own", "bytes"], 4096)(batches)


def _runs(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[bytes, dict, memoryview, int]]:
    """Runs of windows: the text's key, the run, the bytes around, where the text starts there."""
    for batch in slices(batches, "text"):
        data, offsets = text_bytes(batch.column("text"))
        view = memoryview(np.ascontiguousarray(data))
        for key, runs, base in zip(
            batch.column("key").to_pylist(), batch.column("runs").to_pylist(), offsets[:-1].tolist(), strict=True
        ):
            for run in runs:
                yield key, run, view, base


def _judged(parts: DataFrame) -> DataFrame:
    """Parts that repeat as a whole (``again``) or may in part (``open``), and how many kinds have their core; written."""
    kinds = saved(
        parts.groupBy("core", "whole").agg(F.count(F.lit(1)).alias("times"), F.min(F.struct("key", "first")).alias("lead")),
        "suffix-part-kinds", keep=False,
    )
    rivals = kinds.groupBy("core").agg(F.count(F.lit(1)).alias("rivals"))
    known = saved(kinds.join(rivals, "core").where("times > 1 or rivals > 1"), "suffix-part-known", keep=False)
    drop(kinds)
    result = saved(
        parts.join(known, ["core", "whole"]).select(
            "key", "core", "first", "windows", "anchor", "own", "rivals",
            (F.col("times") > 1).alias("again"),
            ((F.col("rivals") > 1) & (F.struct("key", "first") == F.col("lead"))).alias("open"),
        ).where("again or open"),
        "suffix-judged", keep=False,
    )
    drop(known)
    return result


def _with_runs(texts: DataFrame, parts: DataFrame) -> DataFrame:
    """Texts with the parts that go on; what repeats as a whole needs no range of its own any more."""
    run = F.struct("core", "first", "windows", "anchor", (F.col("own") & ~F.col("again")).alias("own"))
    return texts.join(parts.groupBy("key").agg(F.collect_set(run).alias("runs")), "key")


def repeated_ranges(texts: DataFrame) -> DataFrame:
    """Byte ranges ``key, start, end`` of ``key, contexts, text`` that repeat in a part of a context; written."""
    parts = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sent = F.filter("contexts", lambda c: c["sent"])
    runs = texts.select(
        "key", "text",
        F.transform(
            sent,
            lambda c: F.struct(
                c["first"].alias("first"), c["windows"].alias("windows"), c["anchor"].alias("anchor"), (~c["again"]).alias("own")
            ),
        ).alias("runs"),
    )
    texts = texts.select("key", "text")
    steps: list[DataFrame] = []
    while len(steps) < SPLITS:
        found = saved(runs.mapInArrow(_parts(len(steps) + 1), _PART), "suffix-parts", keep=False)
        steps.append(_judged(found))
        drop(found)
        crowded = steps[-1].where(F.col("open") & (F.col("rivals") > MEMBERS))
        if crowded.isEmpty():
            break
        runs = _with_runs(texts, crowded)
    judged = reduce(DataFrame.unionByName, steps)
    first = F.col("first").cast("long")
    alike = judged.where("again and own").select(
        "key", first.alias("start"), (first + F.col("windows") - 1 + LENGTH).alias("end")
    )
    sorted_ = (
        _with_runs(texts, judged.where(F.col("open") & (F.col("rivals") <= MEMBERS)))
        .mapInArrow(_bytes, _BYTES)
        .repartition(parts, "core")
        .sortWithinPartitions("core")
        .mapInArrow(_sorted_buckets, "key binary, start bigint, end bigint")
    )
    result = saved(alike.unionByName(sorted_), "suffix-ranges", keep=False)
    for step in steps:
        drop(step)
    return result


def _batched(rows, kinds: tuple, names: list[str], size: int):
    def batched(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        every = rows(batches)
        while out := list(islice(every, size)):
            columns = zip(*out, strict=True)
            yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=names)

    return batched


def _final(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches, "text"):
        data, offsets = text_bytes(batch.column("text"))
        view = memoryview(np.ascontiguousarray(data))
        rows = []
        for i, (found, more) in enumerate(
            zip(batch.column("contexts").to_pylist(), batch.column("ranges").to_pylist(), strict=True)
        ):
            a, b = int(offsets[i]), int(offsets[i + 1])
            ranges = [(c["first"], c["first"] + c["windows"] - 1 + LENGTH) for c in found if c["again"]]
            ranges += [(r["start"], r["end"]) for r in more or ()]
            rows.append((b - a, *_cut(view[a:b], ranges)[:3]))
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string())
        yield pa.record_batch(
            [batch.column("doc_id"), *(pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds))],
            names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
        )


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row ``doc_id, n_bytes, n_removed, n_spans, kept_sha256``.

    Texts move once to meet their contexts. Most are settled there; only those
    with a context that may repeat in part move again, with what the sort found.
    """
    rows = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"),
        row_key(F.col(doc_id), F.col(text)).alias("key"),
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    contexts = repeated_contexts(rows)
    state = saved(
        rows.join(contexts, "key", "left").select("doc_id", "key", "contexts", "text")
        .mapInArrow(_settled, f"{_RESULT}, {_STATE}"),
        "suffix-state",
    )
    drop(contexts)
    ranges = repeated_ranges(state.where(F.col("text").isNotNull()).select("key", "contexts", "text"))
    by_text = saved(
        ranges.groupBy("key").agg(F.collect_set(F.struct("start", "end")).alias("ranges")), "suffix-by-text"
    )
    drop(ranges)
    names = [c.split()[0] for c in _RESULT.split(", ")]
    ready = state.where(F.col("kept_sha256").isNotNull()).select(*names)
    late = (
        state.where(F.col("kept_sha256").isNull())
        .select("doc_id", "key", "contexts", "text")
        .join(by_text, "key", "left")
        .select("doc_id", "contexts", "ranges", "text")
        .mapInArrow(_final, _RESULT)
    )
    return ready.unionByName(late)
