"""The k most similar vectors of every vector: a small-world graph per shard, shard results merged.

Vectors are routed to shards by the nearest of a set of pivots. Every vector is indexed in its
home shard and searches there and in the next nearest shards. A shard holds one hierarchical
navigable small-world graph as flat neighbour arrays (one matrix of neighbour numbers per layer),
built and searched for many vectors in lockstep, so numpy does the work and not a loop per vector.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from weftline.session import cut

M0, M_UP, EF_BUILD, EF_SEARCH = 24, 12, 48, 64
#: Vectors per shard aimed at, most shards, and shards that each vector searches.
SHARD_ROWS, MAX_SHARDS, PROBES = 1500, 4096, 4
#: Pivots are fitted on at most this many vectors; every vector is indexed.
SAMPLE = 20_000
#: A shard larger than this many times SHARD_ROWS (or the mean, if larger, but at most GRAPH_ROWS) is salted into several graphs, all of
#: which its visitors search; more than VISITORS rows at a shard are dealt to several tasks, each with the shard's graph.
OVERFULL, GRAPH_ROWS, VISITORS = 4, 100_000, 200_000


class Hnsw:
    """Flat-array graph over unit vectors ``x`` (n x d, float32); similarity is the inner product."""

    def __init__(self, x: np.ndarray, seed: int = 7):
        self.x = np.ascontiguousarray(x, dtype=np.float32)
        n = len(self.x)
        level = np.minimum((-np.log(np.random.default_rng(seed).random(n)) / math.log(M0)).astype(int), 6) if n else np.zeros(0, int)
        self.layers: list[tuple[np.ndarray, np.ndarray]] = []  # upper layers: members, neighbours by member number; from the top
        for lv in range(int(level.max(initial=0)), 0, -1):
            members = np.flatnonzero(level >= lv)
            self.layers.append((members, self._exact_graph(members, M_UP)))
        self.graph = np.full((n, M0), -1, dtype=np.int32)
        self._build()

    def _exact_graph(self, members: np.ndarray, m: int) -> np.ndarray:
        """Upper layers are small: neighbours by comparison with all members, in blocks, thinned by the diversity rule."""
        out = np.full((len(members), m), -1, dtype=np.int32)
        for s in range(0, len(members), 512):
            part = members[s : s + 512]
            sims = self.x[part] @ self.x[members].T
            sims[np.arange(len(part)), np.arange(s, s + len(part))] = -np.inf
            c = min(len(members) - 1, 3 * m)
            if c < 1:
                continue
            cand = np.argpartition(-sims, c - 1, axis=1)[:, :c]
            near = np.take_along_axis(sims, cand, 1)
            out[s : s + len(part)] = self._diverse(members[cand], near, m, number=cand)
        return out

    def _diverse(self, cand: np.ndarray, sims: np.ndarray, m: int, number: np.ndarray | None = None) -> np.ndarray:
        """The m neighbours kept per row: nearest first, one that is nearer to a kept one than to the row is left for the end."""
        order = np.argsort(-sims, axis=1, kind="stable")
        cand, sims = np.take_along_axis(cand, order, 1), np.take_along_axis(sims, order, 1)
        number = cand if number is None else np.take_along_axis(number, order, 1)
        rows, width = cand.shape
        valid = np.isfinite(sims)
        vec = self.x[np.where(valid, cand, 0)]
        among = vec @ vec.transpose(0, 2, 1)
        kept = np.zeros((rows, width), dtype=bool)
        for c in range(width):
            worst = np.where(kept, among[:, c, :], -np.inf).max(axis=1)
            kept[:, c] = valid[:, c] & (worst < sims[:, c] + 1e-7) & (kept.sum(axis=1) < m)
        # places left over go to the nearest of those passed by
        first = np.argsort(np.where(kept, 0, np.where(valid, 1, 2)), axis=1, kind="stable")[:, :m]
        out = np.take_along_axis(number, first, 1)
        out = np.where(np.take_along_axis(valid, first, 1), out, -1)
        if out.shape[1] < m:
            out = np.pad(out, ((0, 0), (0, m - out.shape[1])), constant_values=-1)
        return out.astype(np.int32)

    def _build(self) -> None:
        n, done = len(self.x), 0
        while done < n:
            size = min(n - done, max(256, done // 2), 1024)
            new = np.arange(done, done + size)
            sims_in = self.x[new] @ self.x[new].T
            np.fill_diagonal(sims_in, -np.inf)
            c = min(size - 1, EF_BUILD)
            inner = np.argpartition(-sims_in, c - 1, axis=1)[:, :c] if c > 0 else np.zeros((size, 0), int)
            cand, near = new[inner], np.take_along_axis(sims_in, inner, 1)
            if done:
                found, score = self.search(self.x[new], EF_BUILD, upto=done)
                cand, near = np.concatenate([cand, found], 1), np.concatenate([near, score], 1)
            if cand.shape[1]:
                w = min(cand.shape[1], EF_BUILD)
                top = np.argpartition(-near, w - 1, axis=1)[:, :w]
                self.graph[new] = self._diverse(np.take_along_axis(cand, top, 1), np.take_along_axis(near, top, 1), M0)
                self._link_back(new)
            done += size

    def _link_back(self, new: np.ndarray) -> None:
        """Every new edge also leads back; where a node then has too many, the diversity rule thins them."""
        src = np.repeat(new, M0)
        dst = self.graph[new].ravel()
        src, dst = src[dst >= 0], dst[dst >= 0]
        order = np.argsort(dst, kind="stable")
        src, dst = src[order], dst[order]
        nodes, start, count = np.unique(dst, return_index=True, return_counts=True)
        width = int(count.max(initial=0))
        for lo in range(0, len(nodes), 512):
            part, st, ct = nodes[lo : lo + 512], start[lo : lo + 512], count[lo : lo + 512]
            w = int(min(ct.max(), width))
            at = st[:, None] + np.arange(w)[None, :]
            more = np.where(np.arange(w)[None, :] < ct[:, None], src[np.minimum(at, len(src) - 1)], -1)
            cand = np.concatenate([self.graph[part], more], 1)
            cand.sort(axis=1)
            cand[:, 1:][cand[:, 1:] == cand[:, :-1]] = -1
            sims = np.einsum("rcd,rd->rc", self.x[np.maximum(cand, 0)], self.x[part])
            sims[cand < 0] = -np.inf
            c = min(cand.shape[1], 3 * M0)
            top = np.argpartition(-sims, c - 1, axis=1)[:, :c]
            self.graph[part] = self._diverse(np.take_along_axis(cand, top, 1), np.take_along_axis(sims, top, 1), M0)

    def search(self, q: np.ndarray, ef: int, upto: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Numbers and similarities of the ``ef`` best found for each row of ``q``, best first (-1 and -inf where fewer)."""
        n = len(self.x) if upto is None else upto
        ids, sims = np.full((len(q), ef), -1, dtype=np.int64), np.full((len(q), ef), -np.inf, dtype=np.float32)
        block = max(64, min(1024, 8_000_000 // max(n, 1)))
        for s in range(0, len(q), block):
            ids[s : s + block], sims[s : s + block] = self._search(np.ascontiguousarray(q[s : s + block], dtype=np.float32), ef, n)
        return ids, sims

    def _descend(self, q: np.ndarray, n: int) -> np.ndarray:
        """Greedy walk down the upper layers to an entry in the bottom layer."""
        at: np.ndarray | None = None
        for members, graph in self.layers:
            inside = members < n
            if not inside.any():
                continue
            first = int(np.flatnonzero(inside)[0])
            here = np.full(len(q), first) if at is None else np.searchsorted(members, at)
            sim = np.einsum("rd,rd->r", self.x[members[here]], q)
            moving = np.ones(len(q), dtype=bool)
            while moving.any():
                near = graph[here[moving]]
                ok = (near >= 0) & (members[np.maximum(near, 0)] < n)
                s = np.einsum("rcd,rd->rc", self.x[members[np.maximum(near, 0)]], q[moving])
                s[~ok] = -np.inf
                best = s.argmax(axis=1)
                value = s[np.arange(len(best)), best]
                better = value > sim[moving] + 1e-7
                idx = np.flatnonzero(moving)
                here[idx[better]], sim[idx[better]] = near[np.arange(len(best)), best][better], value[better]
                moving[idx[~better]] = False
            at = members[here]
        return np.zeros(len(q), dtype=np.int64) if at is None else at

    def _search(self, q: np.ndarray, ef: int, n: int) -> tuple[np.ndarray, np.ndarray]:
        r = len(q)
        rows = np.arange(r)
        entry = self._descend(q, n)
        ids, sims = np.full((r, ef), -1, dtype=np.int64), np.full((r, ef), -np.inf, dtype=np.float32)
        ids[:, 0], sims[:, 0] = entry, np.einsum("rd,rd->r", self.x[entry], q)
        open_ = np.zeros((r, ef), dtype=bool)
        open_[:, 0] = True
        seen = np.zeros((r, n), dtype=bool)
        seen[rows, entry] = True
        wide = 4
        live = rows
        while len(live):
            # the best few places not yet opened, of every row still walking
            waiting = np.where(open_[live], sims[live], -np.inf)
            pick = np.argpartition(-waiting, min(wide, ef - 1), axis=1)[:, :wide]
            good = np.isfinite(np.take_along_axis(waiting, pick, 1))
            np.put_along_axis(tmp := open_[live], pick, False, 1)
            open_[live] = tmp
            near = self.graph[np.where(good, np.take_along_axis(ids[live], pick, 1), 0)]
            near = np.where(good[:, :, None], near, -1).reshape(len(live), -1)
            near.sort(axis=1)
            fresh = near >= 0
            fresh[:, 1:] &= near[:, 1:] != near[:, :-1]
            safe = np.where(fresh & (near < n), near, 0)
            fresh &= (near < n) & ~seen[live[:, None], safe]
            rr, cc = np.nonzero(fresh)
            seen[live[rr], near[rr, cc]] = True
            score = np.full(near.shape, -np.inf, dtype=np.float32)
            score[rr, cc] = np.einsum("nd,nd->n", self.x[near[rr, cc]], q[live[rr]])
            all_s, all_i = np.concatenate([sims[live], score], 1), np.concatenate([ids[live], near], 1)
            all_o = np.concatenate([open_[live], fresh], 1)
            keep = np.argpartition(-all_s, ef - 1, axis=1)[:, :ef]
            sims[live], ids[live] = np.take_along_axis(all_s, keep, 1), np.take_along_axis(all_i, keep, 1)
            open_[live] = np.take_along_axis(all_o, keep, 1) & np.isfinite(sims[live])
            live = live[open_[live].any(axis=1)]
        order = np.argsort(-sims, axis=1, kind="stable")
        ids, sims = np.take_along_axis(ids, order, 1), np.take_along_axis(sims, order, 1)
        return np.where(np.isfinite(sims), ids, -1), sims


def usable(vectors: DataFrame, vec: str, size: int) -> DataFrame:
    """Rows whose vector can be compared: not null, of the right length, finite, and not all zero."""
    v = F.col(vec)
    sound = v.isNotNull() & (F.size(v) == size) & ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))) & F.exists(v, lambda x: x != 0)
    return vectors.filter(F.coalesce(sound, F.lit(False)))


def _unit(a: np.ndarray) -> np.ndarray:
    a = a.astype(np.float64)
    a /= np.abs(a).max(axis=1, keepdims=True)
    return (a / np.sqrt((a * a).sum(axis=1, keepdims=True))).astype(np.float32)


def _pivots(sample: np.ndarray, count: int) -> np.ndarray:
    """A few rounds of spherical k-means from a spread-out start."""
    rng = np.random.default_rng(11)
    centres = sample[rng.choice(len(sample), count, replace=False)].copy()
    for _ in range(6):
        home = np.concatenate([(sample[s : s + 4096] @ centres.T).argmax(axis=1) for s in range(0, len(sample), 4096)])
        total = np.zeros_like(centres)
        np.add.at(total, home, sample)
        norm = np.sqrt((total * total).sum(axis=1, keepdims=True))
        centres = np.where(norm > 1e-9, total / np.maximum(norm, 1e-9), centres)
    return centres.astype(np.float32)


def most_similar(vectors: DataFrame, key: str, vec: str, k: int = 10, size: int = 64) -> DataFrame:
    """Rows ``(q, c, sim)``: for every vector the (at most) ``k`` most similar others, cosine in double precision.

    Keys are unique whole numbers. Rows without key and unusable vectors (see ``usable``) take no part; other columns are never read. Vectors that are exactly alike are
    indexed once; each of them has the others as neighbours at similarity 1, lowest keys first,
    as all ties go by key. An empty table gives no rows.
    """
    rows = usable(vectors.select(key, vec).filter(F.col(key).isNotNull()), vec, size).select(F.col(key).alias("id"), F.col(vec).cast("array<float>").alias("v"))
    rows = rows.withColumn("copy", F.xxhash64("v"))
    # copies: of each distinct vector the k + 1 lowest keys stand for all (the rank limit works before the shuffle)
    ranked = rows.withColumn("rank", F.row_number().over(Window.partitionBy("copy", "v").orderBy("id"))).filter(F.col("rank") <= k + 1)
    heads, seen = cut(ranked.groupBy("copy", "v").agg(F.array_sort(F.collect_list("id")).alias("ids")), rows=F.lit(True), several=F.size("ids") > 1)
    total = seen["rows"]
    if not total:
        return rows.select(F.col("id").alias("q"), F.col("id").alias("c"), F.lit(0.0).alias("sim")).limit(0)
    share = min(1.0, SAMPLE / total)
    sample = heads.filter(F.pmod(F.xxhash64("copy", F.lit(5)), F.lit(1_000_000)) < int(share * 1_000_000) + 1).select("v").limit(2 * SAMPLE).toPandas()
    sample_x = _unit(np.array(sample["v"].tolist(), dtype=np.float32).reshape(-1, size))
    shards = max(1, min(MAX_SHARDS, round(total / SHARD_ROWS), len(sample_x)))
    pivots = _pivots(sample_x, shards)
    probes = min(PROBES, shards)
    full = max(OVERFULL * SHARD_ROWS, min(OVERFULL * total // shards, GRAPH_ROWS))

    def route(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if not len(pdf):
                continue
            raw = np.array(pdf["v"].tolist(), dtype=np.float32)
            sims = _unit(raw) @ pivots.T
            near = np.argsort(-sims, axis=1, kind="stable")[:, :probes] if probes == shards else np.argpartition(-sims, probes - 1, axis=1)[:, :probes]
            near = np.take_along_axis(near, np.argsort(-np.take_along_axis(sims, near, 1), axis=1, kind="stable"), 1)
            packed = [x.tobytes() for x in raw]
            for p in range(probes):
                yield pd.DataFrame({"shard": near[:, p].astype(np.int32), "home": p == 0, "id": pdf["id"], "raw": packed})

    routed = heads.select(F.col("ids")[0].alias("id"), "v").mapInPandas(route, "shard int, home boolean, id bigint, raw binary")
    # an overfull shard becomes several graphs: its members go to one each, its visitors to all; too many visitors are dealt out
    loads = routed.groupBy("shard").agg(F.count_if("home").alias("n"), F.count(F.lit(1)).alias("v")).filter((F.col("n") > full) | (F.col("v") > VISITORS)).collect() if total > min(full, VISITORS) else []

    def times(counts: dict[int, int]) -> Column:
        if not counts:
            return F.lit(1)
        return F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in counts.items() for x in kv]), F.col("shard")), F.lit(1))

    parts, deals = times({r["shard"]: -(-r["n"] // full) for r in loads}), times({r["shard"]: -(-r["v"] // VISITORS) for r in loads})
    numbers = lambda n: F.sequence(F.lit(0), n - 1)
    placed = routed.withColumns({"own": F.pmod(F.xxhash64("id"), parts).cast("int"), "deal": F.pmod(F.xxhash64("id", F.lit(3)), deals).cast("int")})
    placed = placed.select("*", F.explode(numbers(parts)).alias("part")).withColumn("home", F.col("home") & (F.col("part") == F.col("own")))
    placed = placed.select("*", F.explode(F.when(F.col("home"), numbers(deals)).otherwise(F.array("deal"))).alias("task"))
    placed = placed.select("shard", "part", "task", "home", (F.col("task") == F.col("deal")).alias("asks"), "id", "raw")

    def shard(pdf: pd.DataFrame) -> pd.DataFrame:
        ids = pdf["id"].to_numpy(np.int64)
        home, asks = pdf["home"].to_numpy(bool), pdf["asks"].to_numpy(bool)
        order = np.argsort(ids, kind="stable")
        ids, home, asks = ids[order], home[order], asks[order]
        raw = np.frombuffer(b"".join(pdf["raw"].to_numpy()[order]), dtype=np.float32).reshape(len(ids), size)
        empty = pd.DataFrame({"q": np.zeros(0, np.int64), "c": np.zeros(0, np.int64), "sim": np.zeros(0)})
        if not home.any() or not asks.any():
            return empty
        unit = _unit(raw)
        member, member_ids = unit[home], ids[home]
        graph = Hnsw(member)
        found, _ = graph.search(unit[asks], max(EF_SEARCH, k + 2))
        exact = raw.astype(np.float64)
        exact /= np.abs(exact).max(axis=1, keepdims=True)
        exact /= np.sqrt((exact * exact).sum(axis=1, keepdims=True))
        out_q, out_c, out_s = [], [], []
        mine = exact[home]
        exact, ids = exact[asks], ids[asks]
        for s in range(0, len(ids), 4096):
            f = found[s : s + 4096]
            sims = np.round(np.einsum("rcd,rd->rc", mine[np.maximum(f, 0)], exact[s : s + 4096]), 12)
            c = member_ids[np.maximum(f, 0)]
            sims[(f < 0) | (c == ids[s : s + 4096, None])] = -np.inf
            top = np.lexsort((c, -sims), axis=1)[:, : k + 1]
            good = np.isfinite(np.take_along_axis(sims, top, 1))
            out_q.append(np.repeat(ids[s : s + 4096], good.sum(axis=1)))
            out_c.append(np.take_along_axis(c, top, 1)[good])
            out_s.append(np.take_along_axis(sims, top, 1)[good])
        return pd.DataFrame({"q": np.concatenate(out_q), "c": np.concatenate(out_c), "sim": np.concatenate(out_s)})

    found = placed.groupBy("shard", "part", "task").applyInPandas(shard, "q bigint, c bigint, sim double")
    order = Window.partitionBy("q").orderBy(F.desc("sim"), "c")
    # what one side found is a candidate of the other too; a pair found from both has one rank
    ends = F.array(F.struct(F.col("q").alias("q"), F.col("c").alias("c")), F.struct(F.col("c").alias("q"), F.col("q").alias("c")))
    both = found.select(F.inline(ends), "sim")
    merged = both.withColumn("rank", F.dense_rank().over(order)).filter(F.col("rank") <= k).drop("rank").dropDuplicates(["q", "c"])
    # heads back to their copies: a neighbour stands for its copies, a query's answer goes to each of its own
    if not seen["several"]:
        return merged
    several = heads.filter(F.size("ids") > 1).select(F.col("ids")[0].alias("head"), "ids", "copy", "v")
    other = merged.join(several.select(F.col("head").alias("c"), F.col("ids").alias("_cs")), "c", "left")
    other = other.select("q", F.explode(F.coalesce("_cs", F.array("c"))).alias("c"), "sim")
    every = rows.join(several.select("copy", "v", "head"), ["copy", "v"]).select(F.col("id").alias("_id"), F.col("head").alias("q"))
    twins = rows.join(several.select("copy", "v", "ids"), ["copy", "v"]).select(F.col("id").alias("q"), F.explode("ids").alias("c"), F.lit(1.0).alias("sim")).filter("q <> c")
    spread = other.join(every, "q", "left").select(F.coalesce("_id", "q").alias("q"), "c", "sim")
    both = spread.unionByName(twins)
    return both.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).drop("rank")


#: Queries that meet all rows at once in ``exact_similar``; they go to every executor.
QUERY_ROWS = 8192


def exact_similar(vectors: DataFrame, key: str, vec: str, queries: DataFrame, k: int = 10, size: int = 64) -> DataFrame:
    """Rows ``(q, c, sim)``: for a stated set of query keys the exact ``k`` most similar others among all vectors, ties by key; what ``most_similar`` is measured against.

    The queries go in blocks of ``QUERY_ROWS`` past all rows; every batch of rows keeps the k best of each query. Unusable vectors take no part.
    """
    spark = vectors.sparkSession
    rows = usable(vectors.select(F.col(key).alias("id"), F.col(vec).cast("array<double>").alias("v")).filter("id is not null"), "v", size)
    asked = rows.join(queries.select(F.col(key).alias("id")).distinct(), "id", "left_semi")
    blocks = max(1, -(-asked.count() // QUERY_ROWS))
    found = None

    def unit(a: np.ndarray) -> np.ndarray:
        a = a / np.abs(a).max(axis=1, keepdims=True)
        return a / np.sqrt((a * a).sum(axis=1, keepdims=True))

    for b in range(blocks):
        part = asked.filter(F.pmod(F.xxhash64("id"), F.lit(blocks)) == b).toPandas()
        if not len(part):
            continue
        told = spark.sparkContext.broadcast((part["id"].to_numpy(np.int64), unit(np.array(part["v"].tolist(), dtype=np.float64))))

        def best(batches: Iterator[pd.DataFrame], told=told) -> Iterator[pd.DataFrame]:  # noqa: ANN001
            ids, asked_x = told.value
            for pdf in batches:
                if not len(pdf):
                    continue
                own, x = pdf["id"].to_numpy(np.int64), unit(np.array(pdf["v"].tolist(), dtype=np.float64))
                for s in range(0, len(ids), 1024):
                    sims = np.round(asked_x[s : s + 1024] @ x.T, 12)
                    sims[ids[s : s + 1024, None] == own[None, :]] = -np.inf
                    # all that reach a batch's k-th best, ties included
                    least = np.partition(sims, -k, axis=1)[:, -k] if sims.shape[1] > k else np.full(len(sims), -np.inf)
                    at, of = np.nonzero((sims >= least[:, None]) & np.isfinite(sims))
                    yield pd.DataFrame({"q": ids[s : s + 1024][at], "c": own[of], "sim": sims[at, of]})

        one = rows.mapInPandas(best, "q bigint, c bigint, sim double")
        found = one if found is None else found.unionByName(one)
    if found is None:
        return rows.select(F.col("id").alias("q"), F.col("id").alias("c"), F.lit(0.0).alias("sim")).limit(0)
    order = Window.partitionBy("q").orderBy(F.desc("sim"), "c")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).drop("rank")
