"""Exact n-gram Jaccard self-join with set-relation skipping.

A document's set is its distinct 5-word shingles (64-bit hashes); two documents link when
``100 * |intersection| >= 80 * |union|``. The result is each document's connected component.

1. Equal sets are one class (its representative is the smallest doc_id).
2. Shingle frequencies are counted over all sets in packed blocks; the at most ``HOT_LIMIT`` most frequent shingles
   are ordered last (by frequency), all others by hash. Any total order keeps the join exact; this one keeps
   shared passages out of the prefixes.
3. The inverted index holds the first ``n - ceil(0.8 n) + 1`` shingles of each set (two similar sets share one of
   them). Shingles in one prefix only are dropped, but counted: before a shared shingle they prove differences.
4. Answers of a highly similar set are reused: every index list is first compared with one pivot (its set with the
   fewest unshared shingles). Verified links are contracted; sets in one component need no further comparison.
5. The remaining pairs are exact: entries outside a list's largest component meet the list's size blocks; blocks and
   entries are skipped when positions (unshared shingles before the entry), the number of shared prefix
   shingles or the difference of parity sketches exclude the needed overlap. Pairs that meet in no short list must reach it on long lists
   alone. What is left is verified on whole texts.

Index rows of a hot shingle are spread over many tasks, never gathered in one. Defined cases: null, empty or
white-space text is an empty set, linked with nothing; fewer than five words make one shingle of the whole
sequence; rows of one doc_id are linked through it, whatever their texts. Null doc_ids link nothing, their rows stay
in the result; a component without any doc_id is named by its smallest row key (null where such a row's set is empty).
Where a doc_id is null or repeated, index, sketches and verification go by a hash of id and text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from reviewlab.llm.common import arrow_map, blobs, flat_blobs, give_back, importable, let_go, scratch, shared_path, staged, texts_of
from reviewlab.llm.components import components
from reviewlab.llm.words import distinct_per_text, mix, text_slices, words_of

WORDS = 5
HOT_LIMIT = 1 << 20        # entries of the broadcast frequency table (16 bytes each)
HOT_LEAST = 4              # smallest frequency that can enter it
SKETCH = 8                 # 64-bit words of a set's parity sketch
SHORT_LIST = 16            # entries up to which an index list proposes all its pairs; longer lists have bounds of their own
BUCKET_TOKENS = 1 << 20    # shingles per counting or index bucket
FLUSH_TOKENS = 1 << 21     # shingles a task holds before it hands them on


def shingle_sets(texts: pa.Array, size: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """(sorted distinct shingle hashes of all texts, row bounds)."""
    return distinct_per_text(*words_of(texts, True).windows(size, short=True))


def set_digests(docs: DataFrame) -> DataFrame:
    """(doc_id, n, digest, sketch) of every document's set.

    The sketch has a bit per hash class: whether an odd number of the set's shingles fall in it. The bits in which two
    sketches differ are at most as many as the shingles that are in one of the sets only."""
    def run(batch: pa.RecordBatch) -> pa.Table:
        texts, out = texts_of(batch.column("text")), []
        for lo, hi in text_slices(texts):
            v, b = shingle_sets(texts.slice(lo, hi - lo))
            raw = memoryview(v.tobytes())
            marks = [hashlib.blake2b(raw[8 * x:8 * y], digest_size=16).digest() for x, y in zip(b[:-1].tolist(), b[1:].tolist())]
            row, bit = np.repeat(np.arange(hi - lo), np.diff(b)), (mix(v) >> np.uint64(40)) % np.uint64(64 * SKETCH)
            odd = np.zeros((hi - lo) * 64 * SKETCH, np.uint8)
            cell, times = np.unique(row * (64 * SKETCH) + bit.astype(np.int64), return_counts=True)
            odd[cell] = times & 1
            sketch = np.packbits(odd).view(np.int64)
            out.append(pa.RecordBatch.from_arrays(
                [batch.column("doc_id").slice(lo, hi - lo), pa.array(np.diff(b)), pa.array(marks, pa.binary()),
                 pa.ListArray.from_arrays(pa.array(np.arange(0, len(sketch) + 1, SKETCH, dtype=np.int32)), pa.array(sketch))],
                names=["doc_id", "n", "digest", "sketch"]))
        return pa.Table.from_batches(out)
    return arrow_map(docs.select("doc_id", "text"), run, "doc_id long, n long, digest binary, sketch array<long>")


def _new_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(doc ids, shingles, bounds) of the non-empty sets this task sees for the first time."""
    seen = set()
    for batch in batches:
        texts, ids = texts_of(batch.column("text")), batch.column("doc_id").to_numpy(zero_copy_only=False)
        for lo, hi in text_slices(texts):
            v, b = shingle_sets(texts.slice(lo, hi - lo))
            raw, keep = memoryview(v.tobytes()), []
            for i, (x, y) in enumerate(zip(b[:-1].tolist(), b[1:].tolist())):
                mark = hashlib.blake2b(raw[8 * x:8 * y], digest_size=16).digest()
                if y > x and mark not in seen:
                    seen.add(mark)
                    keep.append(i)
            if keep:
                keep = np.array(keep)
                n = np.diff(b)[keep]
                nb = np.concatenate([[0], np.cumsum(n)])
                yield ids[lo:hi][keep], v[np.repeat(b[keep] - nb[:-1], n) + np.arange(nb[-1])], nb
    give_back()


def prefix_length(n):
    """Shingles of a set of ``n`` that must hold one of any similar set's prefix."""
    return n - (4 * n + 4) // 5 + 1


def _packed(bucket: np.ndarray, columns: list[np.ndarray]) -> pa.RecordBatch:
    """One row per bucket: the bucket and a binary of each column's values there."""
    order = np.argsort(bucket, kind="stable")
    key, start = np.unique(bucket[order], return_index=True)
    bounds = np.append(start, len(order))
    return pa.RecordBatch.from_arrays([pa.array(key.astype(np.int64))] + [blobs(c[order], bounds) for c in columns],
                                      names=["bucket"] + [f"c{i}" for i in range(len(columns))])


def _bucket(token: np.ndarray, buckets: int) -> np.ndarray:
    return (mix(token) >> np.uint64(16)) % np.uint64(buckets)


def frequent_shingles(docs: DataFrame, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes in rising order, frequencies) of the most frequent shingles, at most HOT_LIMIT.

    Counts cover every set's first shingles by hash (one and a half prefixes), combined per task before they are
    shuffled; the frequency cut-off comes from the histogram of all counts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def flush():
            t, c = np.unique(np.concatenate(held), return_counts=True)
            return _packed(_bucket(t, buckets), [t, c.astype(np.uint32)])
        for _, v, b in _new_sets(batches):
            n = np.diff(b)
            take = np.minimum(n, prefix_length(n) * 3 // 2 + 1)
            held.append(v[np.arange(len(v)) - np.repeat(b[:-1], n) < np.repeat(take, n)])
            size += len(held[-1])
            if size >= FLUSH_TOKENS:
                yield flush()
                held, size = [], 0
        if size:
            yield flush()

    def count(group: pa.Table) -> pa.Table:
        t, c = flat_blobs(group.column("c0"), np.uint64)[0], flat_blobs(group.column("c1"), np.uint32)[0]
        u, inv = np.unique(t, return_inverse=True)
        df = np.bincount(inv, weights=c).astype(np.int64)
        u, df = u[df >= HOT_LEAST], df[df >= HOT_LEAST]
        return pa.table({"token": u.view(np.int64), "df": df})

    counts = staged(docs.select("doc_id", "text").mapInArrow(run, "bucket long, c0 binary, c1 binary")
                    .groupBy("bucket").applyInArrow(count, "token long, df long"), "shingle-counts")
    total, least = 0, HOT_LEAST
    for df, n in counts.groupBy("df").count().orderBy(F.desc("df")).toLocalIterator():
        total += n
        if total > HOT_LIMIT:
            least = df + 1
            break
    hot = counts.where(F.col("df") >= least).toArrow()
    t, df = hot.column("token").to_numpy().view(np.uint64), hot.column("df").to_numpy()
    order = np.argsort(t)
    return t[order], df[order]


def prefix_index(docs: DataFrame, hot: tuple[np.ndarray, np.ndarray], buckets: int) -> DataFrame:
    """(token, doc_id, n, pos): prefix entries of shingles that more than one prefix may hold."""
    shipped = docs.sparkSession.sparkContext.broadcast(hot)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, freq = shipped.value
        held, size = [], 0

        def flush():
            t, d, n, p, h = (np.concatenate(x) for x in zip(*held))
            spread = _bucket(np.where(h, mix(t ^ mix(d.view(np.uint64))), t), buckets).astype(np.int64)
            return _packed(np.where(h, -1 - spread, spread), [t, d, n, p])
        for ids, v, b in _new_sets(batches):
            n = np.diff(b)
            at = np.searchsorted(table, v)
            at[at == len(table)] = 0
            df = np.where(table[at] == v, freq[at], 0) if len(table) else np.zeros(len(v), np.int64)
            row = np.repeat(np.arange(len(n)), n)
            order = np.lexsort((v, df, row))
            pos = np.arange(len(v)) - np.repeat(b[:-1], n)
            inside = pos < np.repeat(prefix_length(n), n)
            pick = order[inside]
            held.append((v[pick], ids[row[pick]].astype(np.int64), n[row[pick]].astype(np.int32), pos[inside].astype(np.int32), df[pick] > 0))
            size += len(pick)
            if size >= FLUSH_TOKENS:
                yield flush()
                held, size = [], 0
        if size:
            yield flush()

    def lists(group: pa.Table) -> pa.Table:
        cols = [flat_blobs(group.column(f"c{i}"), k)[0] for i, k in enumerate((np.uint64, np.int64, np.int32, np.int32))]
        keep = slice(None)
        if group.column("bucket")[0].as_py() >= 0:
            _, inv, c = np.unique(cols[0], return_inverse=True, return_counts=True)
            keep = c[inv] > 1
        t, d, n, p = (c[keep] for c in cols)
        return pa.table({"token": t.view(np.int64), "doc_id": d, "n": n.astype(np.int64), "pos": p.astype(np.int64)})

    return (docs.select("doc_id", "text").mapInArrow(run, "bucket long, c0 binary, c1 binary, c2 binary, c3 binary")
            .groupBy("bucket").applyInArrow(lists, "token long, doc_id long, n long, pos long"))


def _needed(na, nb):
    """Smallest intersection that links sets of these sizes."""
    return F.ceil((na + nb) * 4 / 9)


def _tail(n):
    """Shingles after the prefix."""
    return F.ceil(n * 4 / 5) - 1


def _block(n):
    """Size block: sizes within about five per cent."""
    return F.floor(F.log(n.cast("double")) / F.log(F.lit(1.05)))


def _possible(a: str, b: str, held: str = "shared"):
    """Bounds that every shared prefix shingle of two similar sets meets."""
    c = lambda s, x: F.col(f"{s}.{x}")
    na, nb = c(a, "n"), c(b, "n")
    apart = sum((F.bit_count(c(a, "sketch")[i].bitwiseXOR(c(b, "sketch")[i])) for i in range(SKETCH)), F.lit(0))
    return ((5 * F.least(na, nb) >= 4 * F.greatest(na, nb)) & (9 * (c(a, "lone") + c(b, "lone")) <= na + nb)
            & (F.least(c(a, held), c(b, held)) >= _needed(na, nb) - F.greatest(_tail(na), _tail(nb)))
            & (9 * apart <= na + nb))


def _across(lists: DataFrame, long: bool) -> DataFrame:
    """Pairs (a, b) of different components that share enough of the lists' prefix shingles to be similar.

    Short lists propose every pair that shares one; such a pair may share all its long lists too. Pairs that share no
    short list must reach the needed number on long lists alone, which is known of each set before they meet."""
    n, held = F.col("n"), "frequent" if long else "shared"
    span = F.sequence(_block(F.ceil(n * 4 / 5)), _block(F.floor(n * 5 / 4)))

    def reachable(block):
        least, most = F.pow(F.lit(1.05), block) - 1, F.pow(F.lit(1.05), block + 1) + 1
        # the needed number of shared prefix shingles is smallest at one end of the block
        need = [_needed(n, m) - F.greatest(_tail(n), _tail(m)) - 2 for m in (least, n, most)]
        return F.col(held) >= F.least(*need)
    probes = lists.where("component <> main").withColumn("block", F.explode(F.filter(span, reachable)))
    others = lists.withColumn("block", _block(n))
    need = lambda na, nb: _needed(na, nb) - F.greatest(_tail(na), _tail(nb))
    met = (probes.alias("x").join(others.alias("y"), (F.col("x.token") == F.col("y.token")) & (F.col("x.block") == F.col("y.block"))
                                  & (F.col("x.component") != F.col("y.component")) & _possible("x", "y", held)
                                  & ((F.col("y.component") == F.col("y.main")) | (F.col("x.rep") < F.col("y.rep"))))
           .select(F.least("x.rep", "y.rep").alias("a"), F.greatest("x.rep", "y.rep").alias("b"), need(F.col("x.n"), F.col("y.n")).alias("need"),
                   (F.lit(0).cast("long") if long else F.least("x.frequent", "y.frequent")).alias("more")))
    return met.groupBy("a", "b", "need", "more").agg(F.count("*").alias("common")).where("common + more >= need").select("a", "b")


def _verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) whose whole texts link."""
    left = texts.select(F.col("doc_id").alias("a"), F.col("text").alias("ta"))
    right = texts.select(F.col("doc_id").alias("b"), F.col("text").alias("tb"))

    def run(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        a, b = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("a", "b"))
        sets = {}
        ok = np.zeros(len(a), bool)
        ta, tb = texts_of(batch.column("ta")), texts_of(batch.column("tb"))
        for i in range(len(a)):
            for key, text in ((a[i], ta), (b[i], tb)):
                if key not in sets:
                    sets[key] = shingle_sets(text.slice(i, 1))[0]
            x, y = sets[a[i]], sets[b[i]]
            inter = len(np.intersect1d(x, y, assume_unique=True))
            ok[i] = 100 * inter >= 80 * (len(x) + len(y) - inter)
            if len(sets) > 4096:
                sets.clear()
        return pa.RecordBatch.from_arrays([pa.array(a[ok]), pa.array(b[ok])], names=["u", "v"])
    return arrow_map(pairs.join(left, "a").join(right, "b").select("a", "b", "ta", "tb"), run, "u long, v long")


def _bucketed(df: DataFrame, key: str, name: str) -> tuple[DataFrame, str]:
    """Write ``df`` bucketed by ``key`` in the shared folder, so that joins on it move the other side only; and the table's
    name, to be dropped when done."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    n = max(12, int(spark.conf.get("spark.sql.shuffle.partitions")))
    made = "llm_" + path.rsplit("/", 1)[1].replace("-", "_")
    (df.repartition(n, key).write.format("parquet").option("path", path).option("compression", "zstd")
     .bucketBy(n, key).saveAsTable(made))
    return spark.table(made), made


def row_keys(docs: DataFrame) -> tuple[Column, bool]:
    """A long that tells rows of different ids or texts apart, and whether it is doc_id itself (never null or repeated)."""
    doc_id = F.col("doc_id").cast("long")
    plain = docs.groupBy(doc_id.alias("doc_id")).count().where("doc_id is null or count > 1").isEmpty()
    return doc_id if plain else F.xxhash64(doc_id, F.col("text").cast("string")), plain


def _linked(docs: DataFrame, plain: bool, stored: DataFrame | None = None) -> tuple[DataFrame, DataFrame]:
    """(doc_id, n, rep, sketch) of every row and the links (u, v) of their representatives; doc_id is the row key here.
    ``stored`` holds the same rows bucketed by doc_id, where they are at hand."""
    spark = docs.sparkSession
    sets = staged(set_digests(docs), "shingle-sets")
    classes = sets.where("n > 0").groupBy("digest").agg(F.min("doc_id").alias("rep"), F.count("*").alias("k")).where("k > 1")
    members = staged(sets.join(classes, "digest", "left").select("doc_id", "n", F.coalesce("rep", "doc_id").alias("rep"), "sketch"), "shingle-members")
    prefixes = members.select(F.sum(F.col("n") - F.ceil(F.col("n") * 4 / 5) + 1)).first()[0] or 0
    buckets = max(64, int(prefixes * 2 // BUCKET_TOKENS))

    index = prefix_index(docs, frequent_shingles(docs, buckets), buckets)
    entries = (index.join(members.select("doc_id", "rep").distinct(), "doc_id")
               .groupBy("token", "rep").agg(F.min("n").alias("n"), F.min("pos").alias("pos")))
    # lists of one class only (copies in several tasks) prove nothing
    lists = staged(entries, "shingle-index")
    useful = lists.groupBy("token").agg(F.count("*").alias("k")).where("k > 1").select("token")
    own = Window.partitionBy("rep")
    sketches = members.where("doc_id = rep").select("rep", "sketch").dropDuplicates(["rep"])
    entries = (lists.join(useful, "token").join(sketches, "rep")
               .withColumn("lone", F.col("pos") - F.row_number().over(own.orderBy("pos")) + 1)
               .withColumn("shared", F.count("*").over(own)))
    entries = staged(entries, "shingle-entries")
    if stored is None:
        texts = docs.join(entries.select(F.col("rep").alias("doc_id")).distinct(), "doc_id", "left_semi")
        texts, made = _bucketed(texts if plain else texts.dropDuplicates(["doc_id"]), "doc_id", "shingle-texts")
    else:
        texts, made = stored if plain else stored.dropDuplicates(["doc_id"]), None
    let_go(spark)       # the shuffles so far are done with

    # links of one pivot per list
    pivots = (entries.groupBy("token").agg(F.min(F.struct((F.col("n") - F.col("shared") - _tail(F.col("n"))) / F.col("n"), "rep", "n", "lone", "shared", "sketch")).alias("p"))
              .select("token", "p.rep", "p.n", "p.lone", "p.shared", "p.sketch"))
    first = (entries.alias("x").join(pivots.alias("y"), F.col("x.token") == F.col("y.token"))
             .where((F.col("x.rep") != F.col("y.rep")) & _possible("x", "y"))
             .select(F.col("y.rep").alias("a"), F.col("x.rep").alias("b"))
             .groupBy("a", "b").agg(F.count("*").alias("tokens")).select("a", "b"))
    first = staged(first, "pivot-pairs")
    links = staged(_verified(first, texts), "pivot-links")
    let_go(spark)
    label = components(links)

    # pairs across components: entries outside a list's largest component against the list's size blocks
    marked = entries.join(label.select(F.col("id").alias("rep"), "component"), "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    marked = staged(marked.drop("lone", "shared"), "shingle-marked")
    sizes = marked.groupBy("token", "component").agg(F.count("*").alias("k"))
    main = (sizes.groupBy("token").agg(F.count("*").alias("parts"), F.sum("k").alias("total"), F.max(F.struct("k", "component")).alias("m"))
            .where("parts > 1").select("token", F.col("m.component").alias("main"), (F.col("total") > SHORT_LIST).alias("long")))
    # shingles that only one component's sets hold in their prefixes are no common ground of two components
    open_lists = staged(marked.join(main, "token")
                        .withColumn("lone", F.col("pos") - F.row_number().over(own.orderBy("pos")) + 1)
                        .withColumn("shared", F.count("*").over(own)).withColumn("frequent", F.sum(F.col("long").cast("long")).over(own)), "open-lists")
    second = staged(_across(open_lists.where("not long"), False).unionByName(_across(open_lists.where("long"), True)).distinct()
                    .join(first.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")), ["a", "b"], "left_anti"), "cross-pairs")
    let_go(spark)
    links = links.unionByName(staged(_verified(second, texts), "cross-links"))
    if made:
        spark.sql(f"DROP TABLE {made}")
    return members, links


def _keyed(docs: DataFrame, key: Column) -> DataFrame:
    return docs.select(key.alias("doc_id"), F.col("text").cast("string").alias("text"))


def _components_of(members: DataFrame, links: DataFrame) -> DataFrame:
    """``members`` with the component of each row's representative."""
    label = components(links).select(F.col("id").alias("rep"), "component")
    return members.join(label, "rep", "left").withColumn("component", F.coalesce("component", "rep"))


def _owned(docs: DataFrame, key: Column, members: DataFrame) -> DataFrame:
    """(key, doc_id, n, rep) of every row of ``docs``."""
    sets = members.select(F.col("doc_id").alias("key"), "n", "rep").distinct()
    return staged(docs.select(key.alias("key"), F.col("doc_id").cast("long").alias("doc_id")).join(sets, "key"), "shingle-owners")


def similar_components(docs: DataFrame) -> DataFrame:
    """doc_id, n_shingles, component_id of every document."""
    spark = importable(docs.sparkSession)
    with scratch(spark):
        return staged(_similar_components(docs), "components", keep=True)


def _similar_components(docs: DataFrame) -> DataFrame:
    key, plain = row_keys(docs)
    members, links = _linked(_keyed(docs, key), plain)
    if plain:
        return _components_of(members, links).select("doc_id", F.col("n").alias("n_shingles"), F.col("component").alias("component_id"))
    rows = _owned(docs, key, members)
    twice = rows.where("doc_id is not null").groupBy("doc_id").agg(F.min("rep").alias("v"), F.max("rep").alias("w")).where("v <> w")
    ids = rows.join(twice, "doc_id").select(F.col("rep").alias("u"), "v").distinct()
    whole = _components_of(rows, links.unionByName(ids))
    lowest = whole.groupBy("component").agg(F.min("doc_id").alias("lowest"))
    return whole.join(lowest, "component").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("lowest", F.when(F.col("n") > 0, F.col("component"))).alias("component_id"))


def one_of_each(docs: DataFrame) -> DataFrame:
    """Pipeline stage: keep the row with the smallest doc_id (null last) of every group of near copies; columns stay.

    Texts alone make near copies: rows of one doc_id with different texts all stay. Of rows that repeat both one stays,
    but rows with neither doc_id nor words are nobody's copies and all stay."""
    spark = importable(docs.sparkSession)
    name = "row_key"
    while name in docs.columns:
        name += "_"
    with scratch(spark):
        key, plain = row_keys(docs)
        # the whole rows are moved once: verification and the last join read them in their buckets
        rows, made = _bucketed(docs.withColumn(name, key), name, "shingle-rows")
        found = rows.join(_kept_rows(rows, name, plain), name)
        if not plain:
            once = found.where(~F.col(f"{name}_bare")).dropDuplicates([name])
            found = once.unionByName(found.where(F.col(f"{name}_bare")))
        out = staged(found.select(*docs.columns), "near-duplicates", keep=True)
        spark.sql(f"DROP TABLE {made}")
    return out


def _kept_rows(rows: DataFrame, name: str, plain: bool) -> DataFrame:
    """The kept keys in column ``name``, and whether their rows have neither id nor words (column ``name``_bare) unless ``plain``.
    ``rows`` are bucketed by ``name``, their key."""
    key = F.col(name)
    docs = _keyed(rows, key)
    members, links = _linked(docs, plain, docs)
    if plain:
        return staged(_components_of(members, links).where("doc_id = component").select(F.col("doc_id").alias(name)), "kept-rows")
    rows = _components_of(_owned(rows, key, members), links)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "key")).alias("first")
    copied = rows.where("n > 0").groupBy("component").agg(first).select(F.col("first.key").alias(name), F.lit(False).alias(f"{name}_bare"))
    bare = rows.where("n = 0").select(F.col("key").alias(name), F.col("doc_id").isNull().alias(f"{name}_bare")).distinct()
    return staged(copied.unionByName(bare), "kept-rows")
