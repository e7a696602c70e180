"""Near-duplicate groups: SuperMinHash signatures, banding, verification, union.

Signatures. Each shingle walks a pseudo-random permutation of the signature's
places; at step j it offers j + r to the place it is at, so the ranks of one
element are correlated and places are spread evenly. A document stops at the
first step that can't lower any place.

Links. Documents with one shingle set are collapsed to a class first, by a
128-bit fingerprint and the set's size. Buckets are the band keys that two
classes or more share; buckets of the same members count once. Each member is
compared to one of its bucket, the hub: by size and by one byte of each place of
the signatures, and what these can't rule out on full sets. Members that the hub
leaves in another component are then compared to the rest of their bucket, in
blocks: signatures name the rows that may have a link, and only those are fetched
as shingle hashes. Every link is confirmed on full sets, and a link between two
classes that share a band is found whether or not a hub has it. With 30 bands of
5 rows a pair at 0.85 misses all bands with probability 3e-8, at 0.8 with 7e-6, as
if places were independent; those of SuperMinHash differ less from their mean.

Groups are connected components by label propagation with pointer jumping.
Nothing is collected: every list stays a table; hot groups of equal documents
end as one class, hot buckets are split into blocks. Joins between tables that
grow with the documents are merge joins at any size; only texts and dropped ids
are joined as Catalyst finds best.

Texts that are null or have no word get an empty set, link with nothing and are
their own group. A text of fewer words than a shingle is one shingle. Rows that
share a doc_id are one node in ``near_duplicates``: if their texts differ, each
one's links count for it; ``keep_one`` judges each row by its own text. Rows with
a null doc_id get a null group and are kept. Very long texts are read whole; empty
tables give empty tables; other columns, whatever their names, pass through.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quire.llm.spans import mix, runs, shingles, text_buffer, words
from quire.llm.store import discard, materialise, scratch

BANDS, ROWS = 30, 5
PLACES = BANDS * ROWS
#: Members of a bucket that are compared in one task.
BLOCK = 2048
#: Standard errors by which a signature's estimate may lie below the threshold and the pair still be verified.
MARGIN = 6.0
_CLASS = ["f1", "f2", "n_shingles"]


def super_minhash(elements: np.ndarray, of: np.ndarray, n_sets: int, places: int = PLACES) -> np.ndarray:
    """Signatures (n_sets x places, inf for empty sets) of the sets ``of`` which 64-bit hashes are elements.

    All sets take a step together; a set whose places can't be lowered any more leaves.
    """
    h = np.full((n_sets, places), np.inf)
    flat, state, permutation = h.ravel(), elements, None
    for j in range(places):
        if j:
            on = h.max(1) > j
            stay = on[of]
            if not stay.any():
                break
            if permutation is None:  # the step before drew k, so places 0 and k have changed
                of, state, k = of[stay], state[stay], k[stay]
                at = np.arange(len(of))
                permutation = np.broadcast_to(np.arange(places, dtype=np.int16), (len(of), places)).copy()
                permutation[at, k] = 0
            elif not stay.all():
                of, state, permutation = of[stay], state[stay], permutation[stay]
                at = np.arange(len(of))
        state = mix(state + np.uint64(0x9E3779B97F4A7C15))
        r = (state >> np.uint64(40)).astype(np.float64) * 2.0**-24
        k = j + ((state & np.uint64(0xFFFFFFFF)) * np.uint64(places - j) >> np.uint64(32)).astype(np.int64)
        if permutation is None:
            place = k
        else:
            place = permutation[at, k].astype(np.int64)
            permutation[at, k] = permutation[:, j]
        np.minimum.at(flat, of * places + place, r + j)
    return h


def _bands(signature: np.ndarray) -> np.ndarray:
    rows = (signature * 2.0**24).astype(np.uint64).reshape(BANDS, ROWS)
    out = np.arange(1, BANDS + 1, dtype=np.uint64)
    for i in range(ROWS):
        out = mix(out ^ rows[:, i]) * np.uint64(0xC2B2AE3D27D4EB4F)
    return mix(out)


def _prints(x: np.ndarray) -> tuple[int, int]:
    return int(mix(x).sum().view(np.int64)), int(mix(x ^ np.uint64(0xA5A5A5A5F00DCAFE)).sum().view(np.int64))


def _slim(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    return docs.select(docs[f"`{doc_id}`"].cast("long").alias("doc_id"), docs[f"`{text}`"].cast("string").alias("text"))


def _text_sets(column: pa.Array, k: int) -> Iterator[list[np.ndarray]]:
    """Distinct 64-bit shingle hashes of each text, in order, by runs of texts."""
    data, at = text_buffer(column)
    for a, b in runs(at):
        hashes, first = words(data[at[a] : at[b]], at[a : b + 1] - at[a])
        yield [np.unique(shingles(hashes[first[i] : first[i + 1]], k)) for i in range(b - a)]


def _lists(arrays: list[np.ndarray]) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, arrays)]), pa.int32()), pa.array(np.concatenate([np.zeros(0, np.int64), *arrays])))


def _signed(slim: DataFrame, k: int) -> DataFrame:
    """doc_id, n_shingles, f1 and f2 (the set's fingerprint), the keys of its bands and a byte of each place."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, prints, bands, sigs = [], [], [], []
            for sets in _text_sets(batch.column(1), k):
                n = np.array([len(x) for x in sets], np.int64)
                signatures = super_minhash(np.concatenate(sets), np.repeat(np.arange(len(sets)), n), len(sets))
                for x, signature in zip(sets, signatures, strict=True):
                    prints.append(_prints(x))
                    bands.append(_bands(signature).view(np.int64) if len(x) else np.zeros(0, np.int64))
                    sigs.append((signature * 2.0**24).astype(np.uint64).astype(np.uint8).tobytes() if len(x) else b"")
                sizes.append(n)
            f = np.array(prints, np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.concatenate([np.zeros(0, np.int64), *sizes])), pa.array(f[:, 0]), pa.array(f[:, 1]), _lists(bands), pa.array(sigs, pa.binary())], ["doc_id", "n_shingles", "f1", "f2", "bands", "sig"])

    return slim.mapInArrow(sign, "doc_id long, n_shingles long, f1 long, f2 long, bands array<long>, sig binary")


def _sets(slim: DataFrame, k: int) -> DataFrame:
    """(doc_id, f1, set): distinct 64-bit shingle hashes, in order as unsigned numbers."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [x for sets in _text_sets(batch.column(1), k) for x in sets]
            f1 = pa.array([_prints(x)[0] for x in out], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), f1, _lists([x.view(np.int64) for x in out])], ["doc_id", "f1", "set"])

    return slim.mapInArrow(read, "doc_id long, f1 long, set array<long>")


def _printed(docs: DataFrame, text: str, k: int) -> DataFrame:
    """``docs`` and n_shingles, f1 and f2 of each row's text, as a struct column with a name of its own, which comes last."""
    name, place = f"print_{uuid.uuid4().hex}", docs.columns.index(text)
    kind = pa.struct([(c, pa.int64()) for c in ("n_shingles", "f1", "f2")])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [{"n_shingles": len(x), **dict(zip(("f1", "f2"), _prints(x), strict=True))} for sets in _text_sets(batch.column(place), k) for x in sets]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, kind)], [*batch.schema.names, name])

    schema = docs.withColumn(name, F.struct(*[F.lit(0).cast("long").alias(c) for c in ("n_shingles", "f1", "f2")])).schema
    return docs.mapInArrow(read, schema)


def _likely(pairs: DataFrame, reps: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that sizes and signatures can't rule out."""
    side = lambda c: reps.select(F.col("id").alias(c), F.col("n_shingles").alias(f"n_{c}"), F.col("sig").alias(f"sig_{c}")).hint("merge")
    close = F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * percent
    both = pairs.join(side("b"), "b").join(side("a"), "a").where(close).select("a", "b", "sig_a", "sig_b")
    least = _least(percent)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = (np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint8).reshape(-1, PLACES) for i in (2, 3))
            yield batch.select(["a", "b"]).filter(pa.array((x == y).mean(1) >= least))

    return both.mapInArrow(compare, "a long, b long")


def _least(percent: int) -> float:
    j = percent / 100
    return j - MARGIN * float(np.sqrt(j * (1 - j) / PLACES))


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) with 100 * intersection >= percent * union."""
    side = lambda c: sets.select(F.col("id").alias(c), F.col("set").alias(f"set_{c}")).hint("merge")
    both = pairs.join(side("b"), "b").join(side("a"), "a").select("a", "b", "set_a", "set_b")
    # Row by row in the JVM: Arrow batches of pairs would hold a hub's set once for each of its pairs.
    n_a, n_b = F.size("set_a").cast("long"), F.size("set_b").cast("long")
    close = F.least(n_a, n_b) * 100 >= F.greatest(n_a, n_b) * percent
    same = F.when(close, F.size(F.array_intersect("set_a", "set_b"))).otherwise(0).cast("long")
    # 100 * same >= percent * (n_a + n_b - same), with one use of ``same``.
    return both.where(same * (100 + percent) >= (n_a + n_b) * percent).select("a", "b")


def components(edges: DataFrame) -> DataFrame:
    """(id, label): the smallest id reachable, for every id in ``edges`` (a, b)."""
    both = materialise(edges.union(edges.select("b", "a")).where("a <> b").distinct(), "dup-edges")
    labels = materialise(both.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("m")).select("id", F.least("id", "m").alias("label")), "dup-labels")
    while True:
        near = both.join(labels.hint("merge"), both["b"] == labels["id"]).groupBy(F.col("a").alias("id")).agg(F.min("label").alias("near"))
        step = labels.join(near.hint("merge"), "id").select("id", F.least("label", "near").alias("new"), "label")
        step = materialise(step, "dup-step")
        jump = step.select(F.col("id").alias("new"), F.col("new").alias("further")).hint("merge")
        new = materialise(step.join(jump, "new", "left").select("id", F.least("new", F.coalesce("further", "new")).alias("label"), (F.col("label") != F.least("new", F.coalesce("further", "new"))).alias("changed")), "dup-labels")
        discard(labels, step)
        labels = new
        if new.where("changed").limit(1).count() == 0:
            discard(both)
            return labels.select("id", "label")


def _suspects(members: DataFrame, labels: DataFrame, reps: DataFrame, percent: int) -> DataFrame:
    """key, block, id, label and probe of the rows whose signatures allow a link that would join two components.

    ``members``: key, id, hub and n (of the bucket). Every such link has an end outside
    the hub's component; these ends, the probes, meet all members but the hub, block by block.
    """
    of = labels.select("id", "label")
    m = members.join(of.hint("merge"), "id", "left").withColumn("label", F.coalesce("label", "id"))
    hubs = of.select(F.col("id").alias("hub"), F.col("label").alias("hub_label"))
    m = m.join(hubs.hint("merge"), "hub", "left").withColumn("hub_label", F.coalesce("hub_label", "hub"))
    m = m.where("n > 2 AND id <> hub").select("key", "id", "label", "n", (F.col("label") != F.col("hub_label")).alias("out"))
    m = materialise(m, "dup-members")
    open_ = m.where("out").select("key").distinct()
    sigs = reps.select("id", F.col("n_shingles").alias("size"), "sig")
    m_open = m.join(open_.hint("merge"), "key", "left_semi").join(sigs.hint("merge"), "id")
    m_open = materialise(m_open, "dup-open")
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    names = ["key", "block", "id", "label", "size", "sig", "probe"]
    probes = m_open.where("out").withColumn("block", F.explode(F.sequence(F.lit(0), blocks - 1))).withColumn("probe", F.lit(True))
    all_ = m_open.withColumn("block", F.pmod(F.xxhash64("id"), blocks).cast("int")).withColumn("probe", F.lit(False))
    rows = probes.select(names).union(all_.select(names))
    least = _least(percent)

    def compare(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(batches)
        probe = table["probe"].to_numpy(zero_copy_only=False)
        component, n = table["label"].to_numpy(), table["size"].to_numpy()
        sig = np.frombuffer(b"".join(table["sig"].to_pylist()), np.uint8).reshape(-1, PLACES)
        to, hit = np.flatnonzero(~probe), np.zeros(len(probe), bool)
        for i in np.flatnonzero(probe):
            near = to[(component[to] != component[i]) & (100 * np.minimum(n[to], n[i]) >= percent * np.maximum(n[to], n[i]))]
            near = near[(sig[near] == sig[i]).mean(1) >= least]
            hit[near] = True
            hit[i] |= len(near) > 0
        yield from table.select(["key", "block", "id", "label", "probe"]).filter(pa.array(hit)).combine_chunks().to_batches()

    return rows.groupBy("key", "block").applyInArrow(compare, "key long, block int, id long, label long, probe boolean")


def _residual(suspects: DataFrame, sets: DataFrame, refuted: DataFrame | None, percent: int) -> DataFrame:
    """Pairs that would join what hubs left in two components: a forest of each block, not all its pairs.

    The high 32 bits of the shingles' hashes bound an intersection from above, first by
    16 of them and then by all, so no link is ruled out; a pair that the bound lets pass
    joins its ends' components in the block, and later pairs inside one component aren't
    made. ``refuted`` holds pairs that passed before and failed on full sets. Returns a, b and
    the bucket's key of each pair.
    """
    of = suspects.select("id").distinct()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            half = [(x.values.to_numpy().view(np.uint64) >> np.uint64(32)).astype("<u4").tobytes() for x in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(half, pa.binary())], ["id", "half"])

    details = sets.select("id", "set").mapInArrow(cut, "id long, half binary").join(of.hint("merge"), "id", "left_semi")
    if refuted is None:
        details = details.withColumn("never", F.lit(None).cast("array<long>"))
    else:
        both = refuted.select("a", "b").union(refuted.select("b", "a"))
        details = details.join(both.groupBy(F.col("a").alias("id")).agg(F.collect_list("b").alias("never")).hint("merge"), "id", "left")
    rows = suspects.join(details.hint("merge"), "id").select("key", "block", "id", "label", "probe", "half", "never")

    def compare(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(batches)
        probe = table["probe"].to_numpy(zero_copy_only=False)
        ids, component = table["id"].to_numpy(), table["label"].to_numpy().copy()
        sets_ = [np.frombuffer(x.as_buffer(), "<u4") for x in table["half"]]
        n = np.array([len(x) for x in sets_], np.int64)
        never_ = table["never"].to_pylist()
        low = [x.astype(np.uint16) for x in sets_]
        to = np.flatnonzero(~probe)
        out_a, out_b = [], []
        for i in np.flatnonzero(probe):
            near = to[(component[to] != component[i]) & (100 * np.minimum(n[to], n[i]) >= percent * np.maximum(n[to], n[i]))]
            if never_[i]:
                near = near[~np.isin(ids[near], never_[i])]
            if not len(near):
                continue
            held = np.zeros(1 << 16, bool)
            held[low[i]] = True
            sizes = n[near]
            shared = np.add.reduceat(held[np.concatenate([low[k] for k in near])].astype(np.int64), np.cumsum(sizes) - sizes)
            shared = np.minimum(shared, np.minimum(sizes, n[i]))
            near = near[100 * shared >= percent * (sizes + n[i] - shared)]
            while len(near):
                k = near[0]
                x, y = sets_[i], sets_[k]
                same = min(int((y[np.minimum(np.searchsorted(y, x), len(y) - 1)] == x).sum()), len(y))
                if 100 * same < percent * (len(x) + len(y) - same):
                    near = near[1:]
                    continue
                out_a.append(min(ids[k], ids[i]))
                out_b.append(max(ids[k], ids[i]))
                component[component == component[k]] = component[i]
                near = near[component[near] != component[i]]
        bucket = pa.array([key[0].as_py()] * len(out_a), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(out_a, pa.int64()), pa.array(out_b, pa.int64()), bucket], ["a", "b", "key"])

    return rows.groupBy("key", "block").applyInArrow(compare, "a long, b long, key long")


def _buckets(reps: DataFrame) -> DataFrame:
    """key, id, hub and n of the members of every set of classes that share a band; one key stands for buckets of equal members."""
    banded = reps.select("id", F.explode("bands").alias("key"))
    shared = banded.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key")
    found = materialise(banded.join(shared.hint("merge"), "key", "left_semi").distinct(), "dup-banded")
    hub = F.min(F.struct(F.xxhash64("id").alias("h"), "id")).getField("id")
    about = found.groupBy("key").agg(hub.alias("hub"), F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("id", F.lit(1)) % (1 << 40)).alias("s1"), F.bit_xor(F.xxhash64("id", F.lit(2))).alias("s2"))
    one = about.where("n > 1").groupBy("hub", "n", "s1", "s2").agg(F.min("key").alias("key")).select("key", "hub", "n")
    members = materialise(found.join(one.hint("merge"), "key").select("key", "id", "hub", "n"), "dup-buckets")
    discard(found)
    return members


def _classes(full: DataFrame) -> tuple[DataFrame, bool]:
    """(f1, f2, n_shingles, first, id), and whether a doc_id is the first of two classes.

    ``id`` is ``first``, the smallest doc_id, unless rows of one doc_id differ in text: then all
    classes but one that begin with it have a hash of the class for an id.
    """
    classes = full.groupBy(*_CLASS).agg(F.min("doc_id").alias("first"))
    place = F.row_number().over(Window.partitionBy("first").orderBy(*_CLASS))
    classes = classes.withColumn("place", place).select(*_CLASS, "first", F.when(F.col("place") == 1, F.col("first")).otherwise(F.xxhash64(*_CLASS)).alias("id"))
    classes = materialise(classes, "dup-classes")
    return classes, classes.where("id <> first").limit(1).count() > 0


def _links(slim: DataFrame, full: DataFrame, classes: DataFrame, split: bool, k: int, percent: int) -> DataFrame:
    """(a, b): a set of verified links between classes' ids with the components that all links have."""
    first = classes.select(*_CLASS, F.col("first").alias("doc_id"), "id")
    reps = full.join(first.hint("merge"), [*_CLASS, "doc_id"]).select("id", "n_shingles", "bands", "sig")
    reps = materialise(reps, "dup-reps")
    members = _buckets(reps)
    # Repeated rows give a class several representatives; only those in buckets are made one.
    needed = materialise(members.select("id").distinct(), "dup-needed")
    known = reps.join(needed.hint("merge"), "id", "left_semi").select("id", "n_shingles", "sig").groupBy("id").agg(F.first("n_shingles").alias("n_shingles"), F.first("sig").alias("sig"))
    known = materialise(known, "dup-known")
    discard(reps)
    texts = classes.join(needed.hint("merge"), "id", "left_semi").select("id", F.col("first").alias("doc_id"), "f1")
    sets = _sets(slim.join(texts.select("doc_id").distinct(), "doc_id", "left_semi"), k)
    if split:
        sets = sets.join(texts.hint("merge"), ["doc_id", "f1"]).select("id", "set")
    sets = materialise(sets.select(F.col("id") if split else F.col("doc_id").alias("id"), "set").dropDuplicates(["id"]), "dup-sets")
    pairs = members.where("id <> hub").select(F.least("id", "hub").alias("a"), F.greatest("id", "hub").alias("b")).distinct()
    pairs = materialise(_likely(pairs, known, percent), "dup-pairs")
    links, refuted = materialise(_verified(pairs, sets, percent), "dup-links"), None
    while True:
        suspects = materialise(_suspects(members, components(links), known, percent), "dup-suspects")
        rest = materialise(_residual(suspects, sets, refuted, percent), "dup-rest")
        if rest.limit(1).count() == 0:
            return links
        more = materialise(_verified(rest.select("a", "b").distinct(), sets, percent), "dup-links")
        failed = materialise(rest.join(more.hint("merge"), ["a", "b"], "left_anti"), "dup-refuted")
        links = links.union(more)
        if failed.limit(1).count() == 0:
            return links  # each block's forest stands, so nothing in it is left apart
        again = failed.select("a", "b").distinct()
        refuted = again if refuted is None else refuted.union(again)
        # The forests of all other buckets stand.
        members = members.join(failed.select("key").distinct().hint("merge"), "key", "left_semi")


def _grouped(slim: DataFrame, k: int, percent: int, by_id: bool) -> DataFrame:
    """doc_id, n_shingles, f1, f2, and of rows with words ``first`` (of the class), ``component`` and ``label`` (its smallest doc_id).

    With ``by_id`` the classes of the rows that share a doc_id are joined to each other.
    """
    signs = materialise(_signed(slim, k), "dup-signs")
    full = signs.where("n_shingles > 0 AND doc_id IS NOT NULL")
    classes, split = _classes(full)
    links = _links(slim, full, classes, split, k, percent)
    if by_id:
        several = full.select("doc_id", *_CLASS).distinct().groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("doc_id")
        same = full.select("doc_id", *_CLASS).join(several.hint("merge"), "doc_id", "left_semi").join(classes.hint("merge"), _CLASS)
        links = links.union(same.groupBy("doc_id").agg(F.min("id").alias("a"), F.collect_set("id").alias("ids")).select("a", F.explode("ids").alias("b")))
    labels = components(links)
    named = classes.join(labels.hint("merge"), "id", "left").withColumn("component", F.coalesce("label", "id")).withColumn("label", F.col("component"))
    if split:  # components may be named by hashes; their smallest doc_ids are the labels
        named = materialise(named.drop("label"), "dup-named")
        named = named.join(named.groupBy("component").agg(F.min("first").alias("label")).hint("merge"), "component")
    slender = signs.select("doc_id", *_CLASS).withColumn("n_shingles", F.when(F.col("doc_id").isNull(), -F.col("n_shingles")).otherwise(F.col("n_shingles")))
    out = slender.join(named.select(*_CLASS, "first", "component", "label").hint("merge"), _CLASS, "left")
    return out.withColumn("n_shingles", F.abs("n_shingles"))


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words_per_shingle: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row; ``percent`` is the least Jaccard similarity of a link."""
    with scratch() as tables:
        out = _grouped(_slim(docs, doc_id, text), words_per_shingle, percent, by_id=True)
        component = F.when(F.col("doc_id").isNotNull(), F.coalesce("label", "doc_id"))
        out = out.select("doc_id", "n_shingles", component.alias("component_id"))
        return tables.keep(materialise(out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))), "dup-result"))


def keep_one(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words_per_shingle: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one row of each group: that of its smallest doc_id. Rows with a null doc_id or without words stay.

    A row belongs to the group of its own text. Of equal rows in a group one stays.
    """
    key = docs[f"`{doc_id}`"].cast("long")
    with scratch() as tables:
        rows = _grouped(_slim(docs, doc_id, text), words_per_shingle, percent, by_id=False).where("doc_id IS NOT NULL")
        rows = materialise(rows, "dup-rows")
        # The chosen class of a component is the first, by doc_id and fingerprint, of those that begin with its smallest doc_id.
        chosen = rows.where("first = label AND doc_id = first").groupBy("component", "label").agg(F.min(F.struct(*_CLASS)).alias("c")).select("label", "c.*")
        several = tables.keep(materialise(rows.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("doc_id"), "dup-several"))
        gone = rows.where("label IS NOT NULL AND doc_id <> label").select("doc_id")
        gone = tables.keep(materialise(gone.union(several).distinct(), "dup-gone"))
        repeated = several.limit(1).count() > 0
        if repeated:
            chosen = tables.keep(materialise(chosen.join(several.select(F.col("doc_id").alias("label")).hint("merge"), "label", "left_semi"), "dup-chosen"))
    other = f"id_{uuid.uuid4().hex}"
    kept = docs.join(gone.select(F.col("doc_id").alias(other)), key == F.col(other), "left_anti")
    if not repeated:
        return kept
    # Rows that share a doc_id: those without words, and one of the chosen text.
    rows = _printed(docs.join(several.select(F.col("doc_id").alias(other)), key == F.col(other), "left_semi"), text, words_per_shingle)
    mark, place = rows.columns[-1], f"place_{uuid.uuid4().hex}"
    empty = rows.where(F.col(mark)["n_shingles"] == 0)
    chosen = chosen.select(F.col("label").alias(other), F.struct("n_shingles", "f1", "f2").alias(f"{other}p"))
    one = rows.join(chosen, (F.col(f"`{doc_id}`").cast("long") == F.col(other)) & (F.col(mark) == F.col(f"{other}p")), "left_semi")
    one = one.withColumn(place, F.row_number().over(Window.partitionBy(F.col(f"`{doc_id}`"), mark).orderBy(F.col(f"`{text}`")))).where(F.col(place) == 1).drop(place)
    return kept.unionByName(one.unionByName(empty).drop(mark))
