"""Search over many queries at once: an inverted index of terms, inverted lists of vectors, and both fused by rank."""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import stage, stage_by
from .skew import frequent_keys, repeated, salted

TERM = r"[\p{L}\p{N}]+"
K1, B = 1.2, 0.75           # saturation of repeated terms, and share of length normalisation
SCORE = "decimal(20,9)"     # scores are added up as decimals, so their order of arrival changes nothing
FUSED = 60                  # damping of ranks when two rankings are fused
SAMPLE = 100_000            # vectors at most that centroids are trained on
SHARDS = 2                  # shards of texts a shuffle partition at least
SHARD_BYTES = 16 << 20      # bytes of text in a shard, about
PART_ROWS = 8192            # vectors in one part of a list, about
PAIRS = 4 << 20             # pairs of vectors that a task holds at once
_TRAINED = 20               # rounds of training


def terms_of(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(TERM), F.lit(0))


def _parted(text: Column) -> Column:
    """The text in lower case and with a blank at its end, in which only ASCII characters part its terms (``terms_of``)."""
    return F.concat(F.regexp_replace(F.lower(text), r"[^\x00-\x7F\p{L}\p{N}]", " "), F.lit(" "))


def _inverted():
    """The function of a task that inverts one shard of ``_parted`` texts: a row per term, and one without a term that lists all items with their lengths.

    Rows with the same item and length count as one. The functions of tasks are made inside others, so that Spark sends them whole and executors
    need no copy of this package.
    """
    def words(texts):
        """The terms of all texts one after the other, and how many each text has."""
        import numpy as np
        import pyarrow as pa

        texts = texts.cast(pa.large_string())
        _, ends, raw = texts.buffers()
        ends = np.frombuffer(ends, "int64")[texts.offset:texts.offset + len(texts) + 1]
        raw = np.frombuffer(raw, "uint8")[ends[0]:ends[-1]]
        byte = np.arange(256)
        inside = ((byte >= 128) | np.isin(byte, np.frombuffer(b"0123456789abcdefghijklmnopqrstuvwxyz", "uint8")))[raw]
        edges = np.flatnonzero(np.diff(inside, prepend=False))      # starts and ends by turns, as a blank ends each text
        starts, stops = edges[::2], edges[1::2]
        offsets = np.concatenate([[0], np.cumsum(stops - starts)]).astype("int64")
        found = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(raw[inside]))
        return found, np.diff(np.searchsorted(starts, ends - ends[0]))

    def inverted(table):
        import numpy as np
        import pyarrow as pa

        table = table.combine_chunks()
        item, texts = (pa.concat_arrays(table[c].chunks) for c in ("item", "text"))
        terms, size = words(texts)
        code = item.dictionary_encode().indices.fill_null(-1).to_numpy(zero_copy_only=False).astype("int64")
        _, row, text = np.unique((code + 1) * (int(size.max()) + 1) + size, return_index=True, return_inverse=True)
        found = terms.dictionary_encode()
        at = found.indices.to_numpy(zero_copy_only=False).astype("int64")
        pairs, tf = np.unique(at * len(row) + np.repeat(text, size), return_counts=True)
        held = row[pairs % len(row)]
        n = np.concatenate([np.bincount(pairs // len(row), minlength=len(found.dictionary)), [len(row)]])
        ends = pa.array(np.concatenate([[0], np.cumsum(n)]), pa.int32())
        rows = np.concatenate([held, row])
        whole = {"term": pa.concat_arrays([found.dictionary.cast(pa.string()), pa.nulls(1, pa.string())]), "n": pa.array(n, pa.int32()),
                 "items": pa.ListArray.from_arrays(ends, item.take(pa.array(rows))),
                 "tfs": pa.ListArray.from_arrays(ends, pa.array(np.concatenate([tf, np.zeros(len(row), "int64")]), pa.int32())),
                 "lengths": pa.ListArray.from_arrays(ends, pa.array(size[rows], pa.int32())),
                 "_salt": pa.array(np.full(len(n), table["_salt"][0].as_py()), pa.int32())}
        return pa.table(whole)
    return inverted


def _met(mean: float, k: int | None):
    """The function of a task that scores one shard: (query, item, part), parts in units of SCORE.

    With ``k`` those of each query's best items only, ties to the lower item. An item that is null can lie in other shards
    too, so what it has here is always given.
    """
    def met(table):
        from decimal import ROUND_HALF_UP, Decimal

        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        def plain(values):
            return values.to_numpy(zero_copy_only=False)

        table = table.combine_chunks()
        items, tfs, lengths, queries = (pa.concat_arrays(table[c].chunks) for c in ("items", "tfs", "lengths", "queries"))
        term, ends = plain(pc.list_parent_indices(items)), np.concatenate([[0], np.cumsum(plain(pc.list_value_length(items)))])
        coded = items.flatten().dictionary_encode()
        order = plain(pc.sort_indices(coded.dictionary))
        place = np.empty(len(order), "int64")
        place[order] = np.arange(len(order))
        known = coded.dictionary.take(pa.array(order))                       # in the order of items, so places compare like them
        none = len(known)                                                    # the place of null
        place = np.append(place, none)[plain(coded.indices.fill_null(none)).astype("int64")]
        tf, length = plain(tfs.flatten()).astype("float64"), plain(lengths.flatten()).astype("float64")
        share = plain(table["idf"].combine_chunks())[term] * (tf * (K1 + 1) / (tf + K1 * ((1 - B) + B * length / mean)))
        units = share * 1e9
        part = np.floor(units + 0.5)
        for i in np.flatnonzero(np.abs(units - np.floor(units) - 0.5) < 1e-4):      # rounded as the decimal that the number is written as
            part[i] = int(Decimal(repr(float(share[i]))).scaleb(9).quantize(Decimal(1), ROUND_HALF_UP))
        asked = queries.flatten().dictionary_encode()
        by_query = plain(asked.indices).astype("int64")
        turn = np.argsort(by_query, kind="stable")
        rows = plain(pc.list_parent_indices(queries))[turn]
        cuts = np.searchsorted(by_query[turn], np.arange(len(asked.dictionary) + 1))
        out = []
        for q in range(len(asked.dictionary)):
            mine = rows[cuts[q]:cuts[q + 1]]
            places = np.concatenate([place[ends[r]:ends[r + 1]] for r in mine])
            total = np.bincount(places, np.concatenate([part[ends[r]:ends[r + 1]] for r in mine]), none + 1)    # exact: whole numbers
            hit = np.flatnonzero(np.bincount(places, minlength=none + 1))
            if k is not None:
                lost, hit = hit[hit == none], hit[hit < none]
                if len(hit) > k:
                    hit = hit[total[hit] >= np.partition(total[hit], len(hit) - k)[len(hit) - k]]
                    hit = hit[np.lexsort((hit, -total[hit]))[:k]]
                hit = np.concatenate([hit, lost])
            out.append((np.full(len(hit), q), hit, total[hit].astype("int64")))
        query, hit, part = (np.concatenate(x) for x in zip(*out))
        return pa.table({"query": asked.dictionary.take(pa.array(query)), "part": pa.array(part),
                         "item": known.take(pa.array(np.where(hit == none, 0, hit), mask=hit == none))})
    return met


@dataclass(frozen=True)
class TextIndex:
    """``postings(term, n, items, tfs, lengths)``: one row per shard of items (``_salt``) and term, as they lie by shard, so that a
    term of very many items is spread and all that an item has lies together. ``hot``: terms with over 1/1000 of all entries."""

    postings: DataFrame
    hot: DataFrame
    items: int
    mean: float

    @staticmethod
    def build(texts: DataFrame, item: str, text: str) -> TextIndex:
        """Texts are dealt to shards by item, about SHARD_BYTES each, and each shard is inverted by itself; no posting is shuffled.

        Texts without an item are dealt by their number of terms, so that those that count as one meet.
        """
        spark = texts.sparkSession
        buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        size = texts.agg(F.sum(F.octet_length(F.col(text).cast("string")))).first()[0] or 0
        shards = max(SHARDS * buckets, size // SHARD_BYTES + 1)
        shown = texts.select(F.col(item).alias("item"), F.coalesce(F.col(text), F.lit("")).alias("text"))
        dealt = F.when(F.col("item").isNull(), F.xxhash64(F.size(terms_of(F.col("text"))))).otherwise(F.xxhash64("item"))
        found = (shown.withColumn("_salt", F.pmod(dealt, F.lit(shards)).cast("int")).repartition(buckets, "_salt")
                 .select("_salt", "item", _parted(F.col("text")).alias("text")))
        kind = shown.schema["item"].dataType.simpleString()

        listed = found.groupBy("_salt").applyInArrow(
            _inverted(), f"term string, n int, items array<{kind}>, tfs array<int>, lengths array<int>, _salt int")
        postings = stage_by(listed, ["_salt"], "postings", dealt=True)
        whole = postings.filter("term IS NULL").agg(F.sum("n"), F.sum(F.aggregate("lengths", F.lit(0).cast("long"), lambda s, x: s + x))).first()
        entries = postings.filter("term IS NOT NULL").select("term", F.explode("items"))
        return TextIndex(postings, frequent_keys(entries, "term"), whole[0] or 0, (whole[1] or 0) / max(whole[0] or 0, 1))

    def scores(self, queries: DataFrame, query: str, text: str, k: int | None = None) -> DataFrame:
        """(query, item, score) of all items that hold a term of the query; with ``k`` at least those that ``best`` takes. Only
        queries are moved to the postings, and each shard gives no more than its own ``k`` best.
        """
        kind = queries.schema[query].dataType.simpleString(), self.postings.schema["items"].dataType.elementType.simpleString()
        wanted = stage(queries.select(F.col(query).alias("query"), F.explode(F.array_distinct(terms_of(text_of(text)))).alias("term"))
                       .groupBy("term").agg(F.collect_list(F.struct("query")).alias("queries")), "wanted")
        often = self.postings.select("term", "n").join(wanted.select("term"), "term").groupBy("term").agg(F.sum("n").alias("df"))
        idf = F.log(F.lit(1.0) + (F.lit(float(self.items)) - F.col("df") + 0.5) / (F.col("df") + 0.5))
        weighed = stage(wanted.join(often, "term").select("term", idf.alias("idf"), F.col("queries.query").alias("queries")), "weighed")
        found = (self.postings.join(weighed, "term").select("_salt", "items", "tfs", "lengths", "idf", "queries")
                 .groupBy("_salt").applyInArrow(_met(float(self.mean), k), f"query {kind[0]}, item {kind[1]}, part long"))
        unit = F.expr("cast(cast(_sum as decimal(20,0)) * 0.000000001BD as decimal(30,9))")
        return found.groupBy("query", "item").agg(F.sum("part").alias("_sum")).select("query", "item", unit.alias("score"))


def text_of(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(""))


def best(scored: DataFrame, k: int) -> DataFrame:
    """The ``k`` best items of each query, with ``rank``; ties go to the lower item. Each task drops all but its own ``k`` first."""
    order = Window.partitionBy("query").orderBy(F.col("score").desc(), "item")
    return scored.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _unit(vector: Column) -> Column:
    """The vector at length one; null for a zero or null one."""
    v = vector.cast("array<double>")
    size = F.sqrt(F.aggregate(v, F.lit(0.0), lambda s, x: s + x * x))
    return _once(size, lambda size: F.when(size > 0, F.transform(v, lambda x: x / size)))


def _once(value: Column, use) -> Column:
    """``use(value)``, with the value worked out once a row: as it stands in a function over an array, it would be for each element."""
    return F.get(F.transform(F.array(value), use), 0)


def _dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def _lists(unit: Column, centroids: list, n: int) -> Column:
    """Numbers of the ``n`` nearest centroids, by likeness, ties to the smaller number."""
    known = F.from_json(F.lit(json.dumps([{"i": i, "c": c} for i, c in enumerate(centroids)])), "array<struct<i:int,c:array<double>>>")
    ranked = _once(unit, lambda unit: F.sort_array(F.transform(known, lambda e: F.struct((-_dot(unit, e["c"])).alias("far"), e["i"].alias("i")))))
    return F.transform(F.slice(ranked, 1, n), lambda e: e["i"])


@dataclass(frozen=True)
class VectorIndex:
    """``entries(list, item, unit)`` as they lie by list of the nearest centroid; lists of very many vectors are spread."""

    entries: DataFrame
    hot: DataFrame
    centroids: list

    @staticmethod
    def build(vectors: DataFrame, item: str, vector: str, lists: int = 64, seed: int = 1) -> VectorIndex:
        """Centroids are trained on at most SAMPLE vectors; every vector is listed. Zero and null vectors are in no list."""
        from pyspark.ml.clustering import KMeans
        from pyspark.ml.functions import array_to_vector

        units = stage(vectors.select(F.col(item).alias("item"), _unit(F.col(vector)).alias("unit")).filter("unit IS NOT NULL"), "units")
        sample = units.orderBy(F.xxhash64("item"), "item").limit(SAMPLE).select(array_to_vector("unit").alias("features"))
        if units.isEmpty():
            return VectorIndex(units.withColumns({"list": F.lit(0), "_salt": F.lit(0)}), frequent_keys(units.withColumn("list", F.lit(0)), "list"), [])
        model = KMeans(k=lists, seed=seed, maxIter=_TRAINED).fit(sample)
        centroids = [_plain_unit(c.tolist()) for c in model.clusterCenters()]       # as many as lists
        listed = stage(units.withColumn("list", F.get(_lists(F.col("unit"), centroids, 1), 0)), "listed")
        parts = F.ceil(F.col("count") / PART_ROWS).cast("int")
        hot = stage(listed.groupBy("list").count().where(F.col("count") > PART_ROWS).select("list", parts.alias("_hot")), "hot-lists")
        return VectorIndex(stage_by(salted(listed, "list", hot, F.col("item")), ["list", "_salt"], "lists"), hot, centroids)

    def scores(self, queries: DataFrame, query: str, vector: str, probes: int | None = None, k: int | None = None) -> DataFrame:
        """(query, item, score): exact cosines with the vectors of the ``probes`` nearest lists of each query (default: all, which
        is an exact search); with ``k`` at least those that ``best`` takes, as each part of a list gives its own ``k`` best.

        Only queries are moved. A task holds one part of a list, the queries that ask it, and PAIRS of their pairs.
        """
        asked = queries.select(F.col(query).alias("query"), _unit(F.col(vector)).alias("asked")).filter("asked IS NOT NULL")
        near = _lists(F.col("asked"), self.centroids, probes or max(1, len(self.centroids)))
        sent = repeated(asked.withColumn("list", F.explode(near)), "list", self.hot)
        if k is None:
            met = self.entries.join(sent, ["list", "_salt"])
            return met.select("query", "item", _dot(F.col("unit"), F.col("asked")).alias("score"))
        kinds = asked.schema["query"].dataType.simpleString(), self.entries.schema["item"].dataType.simpleString()
        return self.entries.groupBy("list", "_salt").cogroup(sent.groupBy("list", "_salt")).applyInArrow(
            _cosines(k), f"query {kinds[0]}, item {kinds[1]}, score double")


def _cosines(k: int):
    """The function of a task that compares one part of a list with its queries: (query, item, score) of each query's ``k`` best.

    A matrix product names the pairs that can be among them, with an allowance for its order of addition. Their scores are then
    added up component by component, as Spark and SQL do it, and ranked. Vectors of unlike lengths have a null score, which comes last; NaN comes first.
    """
    def dense(values):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        values = pa.concat_arrays(values.chunks)
        size = pc.list_value_length(values).to_numpy(zero_copy_only=False).astype("int64")
        out = np.zeros((len(size), int(size.max())))
        out[np.arange(out.shape[1]) < size[:, None]] = values.flatten().to_numpy(zero_copy_only=False)
        return out, size

    def cosines(entries, queries):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        kinds = pa.schema([("query", queries.schema.field("query").type), ("item", entries.schema.field("item").type), ("score", pa.float64())])
        if not len(entries) or not len(queries):
            return kinds.empty_table()
        entries = entries.take(pc.sort_indices(entries["item"], null_placement="at_start"))     # ties go to the first row
        item, query = entries["item"].combine_chunks(), queries["query"].combine_chunks()
        (units, size), (asked, asked_size) = dense(entries["unit"]), dense(queries["asked"])
        wide = max(units.shape[1], asked.shape[1])
        units, asked = (np.pad(x, ((0, 0), (0, wide - x.shape[1]))) for x in (units, asked))
        step, found = max(1, PAIRS // len(units)), []
        for first in range(0, len(asked), step):
            block = asked[first:first + step]
            alike = asked_size[first:first + step, None] == size
            rough = np.where(alike, np.nan_to_num(block @ units.T, nan=np.inf, posinf=np.inf, neginf=np.inf), -np.inf)
            last = max(0, len(units) - k)
            at, row = np.nonzero(rough >= np.partition(rough, last, axis=1)[:, last, None] - 1e-9)
            score = np.zeros(len(at))
            for c in range(wide):
                score += block[at, c] * units[row, c]
            fits = alike[at, row]
            order = np.lexsort((row, -np.where(fits, np.where(np.isnan(score), np.inf, score), -np.inf), at))
            keep = order[np.arange(len(order)) - np.searchsorted(at, at) < k]       # ``at`` ascends, so it starts where its order does
            found.append((first + at[keep], row[keep], score[keep], fits[keep]))
        at, row, score, fits = (np.concatenate(x) for x in zip(*found))
        return pa.table([query.take(pa.array(at)), item.take(pa.array(row)), pa.array(score, mask=~fits)], schema=kinds)
    return cosines


def _plain_unit(c: list[float]) -> list[float]:
    size = sum(x * x for x in c) ** 0.5 or 1.0
    return [x / size for x in c]


def fused(rankings: list[DataFrame], k: int) -> DataFrame:
    """The ``k`` items of each query with the greatest sum of 1 / (FUSED + rank) over the rankings (query, item, rank)."""
    both = rankings[0].select("query", "item", "rank")
    for more in rankings[1:]:
        both = both.unionByName(more.select("query", "item", "rank"))
    share = (F.lit(1.0) / (F.lit(FUSED) + F.col("rank"))).cast(SCORE)
    return best(both.groupBy("query", "item").agg(F.sum(share).alias("score")), k)
