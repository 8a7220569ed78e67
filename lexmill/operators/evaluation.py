"""Retrieval measures: relevance of units, recall, answerable recall, comparisons."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexmill.functions.text import ARTICLE, has_all, norm_name, propose_keys, text
from lexmill.operators import names

KS = (1, 3, 5, 10)
#: How many ids a tile of matches has at each of its two sides.
SIDE = 2048


def match_sources(questions: DataFrame, units: DataFrame, qid: str = "qid", expected: str = "expected_sources", mode: str = "loose") -> DataFrame:
    """(qid, id) of the units that are an expected source.

    Expected names are parsed once; the different ones meet the different (law, number) of the units in
    a trie (names.matched_names), which gives matches only. Questions that ask alike and units that can be asked
    for alike are matched as one, so a pair of such groups is shuffled and no pair of theirs is: ids go in tiles
    of SIDE questions and units, dealt out evenly, and become rows where the result is used.
    mode strict: plain containment, and no branch articles.
    """
    strict = mode == "strict"
    article_pattern = r"제\d+조" if strict else ARTICLE
    e = questions.select(F.col(qid).alias("qid"), F.explode(expected).alias("e")).select("qid", norm_name("e").alias("e")).distinct()
    annex = F.regexp_extract("e", r"별표(\d+)", 1)
    article = F.regexp_extract("e", f"({article_pattern})", 1)
    e = e.withColumns({"kind": F.when(annex != "", "annex").when(article != "", "article").otherwise("law"), "number": F.when(annex != "", annex).otherwise(article)})
    head = F.when(F.col("kind") == "annex", F.regexp_extract("e", r"^(.*?)별표\d+", 1)).when(F.col("kind") == "article", F.regexp_extract("e", f"^(.*?)(?:{article_pattern})", 1)).otherwise(F.col("e"))
    e = e.withColumn("name", head).filter("name != ''").select("qid", "kind", "number", "name").distinct()
    asking, asked_by = _alike(e.groupBy("qid").agg(F.array_sort(F.collect_set(F.struct("kind", "number", "name"))).alias("what")), "qid")
    known, known_by = _alike(units.groupBy("id").agg(F.array_sort(F.collect_set(F.struct("law", "article", "annex"))).alias("what")), "id")
    numbered = names.by_number(known.select("group", F.explode("what").alias("u")).select("group", "u.*"), "group")
    asked = e.select("kind", "number", "name").distinct()
    wanted = asked.select("kind", "number").distinct()
    keys = numbered.select("kind", "number", "law").distinct().join(wanted, ["kind", "number"], "left_semi")
    found = asking.select(F.col("group").alias("asking"), F.explode("what").alias("a")).select("asking", "a.*").join(names.matched_names(asked, keys, strict), ["kind", "number", "name"])
    pairs = found.select("asking", "kind", "number", "law").distinct().join(numbered.withColumnRenamed("group", "known"), ["kind", "number", "law"]).select("asking", "known").distinct()
    tiles = pairs.join(asked_by.toDF("asking", "qids"), "asking").join(known_by.toDF("known", "ids"), "known").select("qids", "ids")
    dealt = tiles.repartition(int(tiles.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return dealt.select(F.explode_outer("qids").alias("q"), "ids").select("q", F.explode_outer("ids").alias("u")).select(F.col("q.qid").alias("qid"), F.col("u.id").alias("id"))


def _alike(df: DataFrame, of: str) -> tuple[DataFrame, DataFrame]:
    """(group, what, n) of the different what of df, and (group, tile) with the ids of each group in arrays of some SIDE.

    A group is named by its least id, as a struct, so that an id may be null. df has an id once.
    """
    one = F.struct(of)
    groups = df.groupBy("what").agg(F.min(one).alias("group"), F.count("*").alias("n"))
    tile = F.pmod(F.xxhash64(of), F.ceil(F.col("n") / SIDE))
    return groups, df.join(groups, "what").groupBy("group", tile.alias("_tile")).agg(F.collect_list(one).alias("tile")).select("group", "tile")


def best_ranks(rankings: DataFrame, relevant: DataFrame, questions: DataFrame) -> DataFrame:
    """(retriever, qid, best): the first relevant rank of every question, null for a miss.

    rankings (qid, retriever, rank, doc), relevant (qid, doc), questions (qid).
    """
    hit = rankings.join(relevant.select("qid", "doc").distinct(), ["qid", "doc"], "left_semi").groupBy("retriever", "qid").agg(F.min("rank").alias("best"))
    every = questions.select("qid").distinct().join(rankings.select("retriever").distinct(), how="cross")
    return every.join(hit, ["retriever", "qid"], "left")


def recall_at_k(best: DataFrame, by: tuple[str, ...] = (), ks: tuple[int, ...] = KS) -> DataFrame:
    """(retriever, by..., k, hits, n, percent)."""
    wide = best.groupBy("retriever", *by).agg(F.count("*").alias("n"), F.map_from_arrays(F.lit(list(ks)), F.array(*(F.count_if(F.col("best") <= k) for k in ks))).alias("_hits"))
    rows = wide.select("retriever", *by, "n", F.explode("_hits").alias("k", "hits"))
    return rows.select("retriever", *by, "k", "hits", "n", F.bround(100 * F.col("hits") / F.col("n")).cast("int").alias("percent"))


def recall_by(best: DataFrame, questions: DataFrame, gaps: Column, status: str = "status", ks: tuple[int, ...] = KS) -> DataFrame:
    """recall_at_k by subset; subsets overlap, so a question counts in each of its own."""
    tag = lambda cond, name: F.when(cond, F.lit(name))
    provisional = text(status) == "provisional"
    tags = F.array_compact(F.array(F.lit("all"), tag(~provisional, "verified"), tag(provisional & ~gaps, "provisional"), tag(~gaps, "in_corpus")))
    subsets = questions.select("qid", F.explode(tags).alias("subset"))
    return recall_at_k(best.join(subsets, "qid"), ("subset",), ks)


def rank_delta(best: DataFrame, a: str, b: str) -> DataFrame:
    """(qid, best_a, best_b, delta): same, up (b finds it earlier), down, or both_miss."""
    wide = best.groupBy("qid").agg(F.min(F.when(F.col("retriever") == a, F.col("best"))).alias("best_a"), F.min(F.when(F.col("retriever") == b, F.col("best"))).alias("best_b"))
    x, y = F.col("best_a"), F.col("best_b")
    delta = F.when(x.isNull() & y.isNull(), "both_miss").when(x.eqNullSafe(y), "same").when(y.isNotNull() & (x.isNull() | (y < x)), "up").otherwise("down")
    return wide.withColumn("delta", delta)


def keyed_questions(questions: DataFrame, keys: str = "answer_keys", truth: str = "ground_truth") -> DataFrame:
    """questions with keys (proposed ones where none are given) and proposed."""
    given = F.coalesce(F.size(keys), F.lit(0)) > 0
    own = F.transform(propose_keys(truth), lambda k: F.array(k))
    return questions.withColumn("proposed", ~given).withColumn(keys, F.when(given, F.col(keys)).otherwise(own))


def answerable_recall(rankings: DataFrame, questions: DataFrame, units: DataFrame, keys: str = "answer_keys", ks: tuple[int, ...] = KS) -> DataFrame:
    """(retriever, mode, k, hits, n): strict, where one unit of the first k holds every key, and
    union, where they do together. Only units that are ranked within the largest k are read."""
    asked = questions.filter(F.coalesce(F.size(keys), F.lit(0)) > 0).select("qid", keys)
    near = rankings.filter(F.col("rank") <= max(ks)).join(asked, "qid").join(units.select(F.col("id").alias("doc"), "text"), "doc")
    single = near.withColumn("one", has_all("text", keys))
    rows = single.groupBy("retriever", "qid").agg(F.min(F.when(F.col("one"), F.col("rank"))).alias("strict"), F.array_sort(F.collect_list(F.struct("rank", "text"))).alias("t"), F.first(keys).alias("keys"))
    together = lambda k: has_all(F.array_join(F.transform(F.filter("t", lambda x: x["rank"] <= k), lambda x: x["text"]), " "), F.col("keys"))
    wide = rows.select("retriever", "qid", "strict", *(together(k).alias(f"u{k}") for k in ks))
    n = asked.select("qid").distinct().agg(F.count("*").alias("n"))
    each = [F.struct(F.lit(m).alias("mode"), F.lit(k).alias("k"), F.when(cond, 1).otherwise(0).alias("hit")) for k in ks for m, cond in (("strict", F.col("strict") <= k), ("union", F.col(f"u{k}")))]
    hits = wide.select("retriever", F.explode(F.array(*each)).alias("x")).groupBy("retriever", "x.mode", "x.k").agg(F.sum("x.hit").alias("hits"))
    return hits.join(F.broadcast(n), how="cross")


def source_hit_answer_miss(rankings: DataFrame, best: DataFrame, questions: DataFrame, units: DataFrame, keys: str = "answer_keys", k: int = 5) -> DataFrame:
    """(retriever, qid): a relevant unit is within the first k, but their texts lack a key."""
    asked = questions.filter(F.coalesce(F.size(keys), F.lit(0)) > 0).select("qid", keys)
    near = rankings.filter(F.col("rank") <= k).join(asked, "qid").join(units.select(F.col("id").alias("doc"), "text"), "doc")
    joined = near.groupBy("retriever", "qid").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rank", "text"))), lambda x: x["text"]), " ").alias("t"), F.first(keys).alias("keys"))
    return joined.filter(~has_all("t", F.col("keys"))).join(best.filter(F.col("best") <= k), ["retriever", "qid"], "left_semi").select("retriever", "qid")


def parity_check(a: DataFrame, b: DataFrame, tolerance: int = 1, ks: tuple[int, ...] = (1, 3)) -> DataFrame:
    """(k, hits_a, hits_b, ok) of two recall_at_k tables of one retriever each."""
    pick = lambda df, name: df.filter(F.col("k").isin(*ks)).select("k", F.col("hits").alias(name))
    both = pick(a, "hits_a").join(pick(b, "hits_b"), "k", "full_outer")
    return both.withColumn("ok", F.coalesce(F.abs(F.col("hits_a") - F.col("hits_b")) <= tolerance, F.lit(False)))


def ranked_hits(rankings: DataFrame, relevant: DataFrame, n: int = 10) -> DataFrame:
    """rankings' first n rows with hit."""
    marks = relevant.select("qid", "doc").distinct().withColumn("hit", F.lit(True))
    return rankings.filter(F.col("rank") <= n).join(marks, ["qid", "doc"], "left").withColumn("hit", F.coalesce("hit", F.lit(False)))
