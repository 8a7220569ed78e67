"""Operator 7, URL filters as a temporal list join (DataFrame functions only).

Dated list entries (add or remove a host, a domain with its subdomains, or a path prefix of a host)
become validity intervals: each add lasts until the next entry of the same rule. Every capture is
evaluated as of its fetch time against the entries then active.

The as-of join is a sort and merge: captures and list changes lie together by host (prefix rules: by
host and prefix), in the order of time, and each capture takes the last change before or at its fetch time.

The captures' distinct hosts are counted first (summed before the shuffle), so a host with a third of
all captures costs the list side one row; their suffixes are joined with the host and domain rules.
The rules of a host are at most its labels and one; what they do together is one line of changes, each with
the number of active rules and the first one's name. Prefix rules, of which one host may have very many, meet by equality first: a
capture's path is cut at the different lengths of its host's prefixes, and cuts that are no prefix go. Both merges deal a host with
over PER_TASK captures out to as many tasks as it needs, by a salt from its count, and give each the host's changes.

Defined results: a capture with a null URL, a URL without a host or a null time matches nothing and
is kept with blocked = false; list entries with a null date, rule or value are ignored; at equal
dates `remove` wins; an entry is active from its date on and until just before its end; repeated
captures repeat; an empty list blocks nothing. The result has the caller's key, host, blocked,
n_rules and first_rule, so clashing names of other columns play no part.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lexmill.llm.tables import fresh, keep, listed

#: Captures of one host that one task takes.
PER_TASK = 200_000
HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:@]+)"
PATH = r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^#]*)"


def validity(entries: DataFrame) -> DataFrame:
    """(rule, value, action, dated) entries -> (rule, host, path, valid_from, valid_to) intervals.

    rule: host, domain or prefix (its value is host and path). Entries of one rule are few, as a
    list changes by day; the window is by rule and value.
    """
    clean = entries.select(F.lower("rule").alias("rule"), F.col("value"), F.lower("action").alias("action"), F.col("dated").cast("timestamp").alias("dated")).dropna()
    once = clean.groupBy("rule", "value", "dated").agg(F.max("action").alias("action"))  # remove > add
    later = F.lead("dated").over(Window.partitionBy("rule", "value").orderBy("dated"))
    host = F.lower(F.substring_index("value", "/", 1))
    return (
        once.withColumn("valid_to", later)
        .filter("action = 'add'")
        .select("rule", host.alias("host"), F.when(F.col("rule") == "prefix", F.expr("substring(value, length(substring_index(value, '/', 1)) + 1)")).otherwise("").alias("path"), F.col("dated").alias("valid_from"), "valid_to", F.concat_ws(":", "rule", "value").alias("name"))
    )


def _changes(intervals: DataFrame, *by: str) -> DataFrame:
    """(by..., time, active): when the rule of each `by` begins and ceases to be active."""
    ends = F.array(F.struct(F.col("valid_from").alias("time"), F.lit(True).alias("active")), F.struct(F.col("valid_to").alias("time"), F.lit(False).alias("active")))
    each = intervals.select(*by, F.explode(ends).alias("c")).select(*by, "c.time", "c.active").filter("time is not null")
    return each.groupBy(*by, "time").agg(F.max("active").alias("active"))  # an interval that follows another at once


def _as_of(rows: DataFrame, changes: DataFrame, by: list[str], time: str, facts: list[str]) -> DataFrame:
    """rows with the facts of the last of changes (by..., time, facts...) that is not later than the row's own time."""
    kind = fresh(rows, "kind")
    nothing = [F.lit(None).cast(dict(changes.dtypes)[f]).alias(f) for f in facts]
    own = rows.select("*", *nothing, F.lit(1).alias(kind))
    other = changes.select(*by, F.col("time").alias(time), *facts, F.lit(0).alias(kind))
    merged = own.unionByName(other, allowMissingColumns=True)
    before = Window.partitionBy(*by).orderBy(time, kind).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    last = [F.last(f, ignorenulls=True).over(before).alias(f) for f in facts]
    return merged.select(*rows.columns, kind, *last).filter(F.col(kind) == 1).drop(kind)


def timelines(rules: DataFrame) -> DataFrame:
    """(host, time, n_own, first_own): after each change of a host's rules (host, name, valid_from, valid_to) how
    many are active, and the first one's name ('' for none)."""
    changes = _changes(rules, "host", "name")
    grid = changes.select("host", "time").distinct().join(changes.select("host", "name").distinct(), "host")
    then = _as_of(grid, changes, ["host", "name"], "time", ["active"])
    active = F.coalesce("active", F.lit(False))
    return then.groupBy("host", "time").agg(F.count_if(active).cast("int").alias("n_own"), F.coalesce(F.min(F.when(active, F.col("name"))), F.lit("")).alias("first_own"))


def evaluate(captures: DataFrame, entries: DataFrame, key: str = "page_id", url: str = "url", fetched: str = "fetched") -> DataFrame:
    """(key, host, blocked, n_rules, first_rule) for every capture, as of its fetch time."""
    seen = captures.select(
        F.col(key).alias("key"),
        F.lower(F.regexp_extract(F.col(url), HOST, 1)).alias("host"),
        F.regexp_extract(F.col(url), PATH, 1).alias("path"),
        F.col(fetched).cast("timestamp").alias("at"),
    )
    hosts = keep(seen.filter("host != ''").groupBy("host").agg(F.ceil(F.count("*") / PER_TASK).cast("int").alias("parts")))
    suffixes = hosts.withColumn("labels", F.split("host", r"\.")).select(
        "host",
        F.explode(F.transform(F.sequence(F.lit(1), F.size("labels")), lambda k: F.array_join(F.slice("labels", k, F.size("labels")), "."))).alias("suffix"),
    )
    intervals = keep(validity(entries))
    prefixes = intervals.filter("rule = 'prefix'").withColumnRenamed("path", "prefix").drop("rule")
    same = (F.col("rule") == "domain") | (F.col("host") == F.col("suffix"))
    own_rules = suffixes.join(intervals.filter("rule != 'prefix'").withColumnRenamed("host", "suffix"), "suffix").filter(same)
    lines = timelines(own_rules.select("host", "name", "valid_from", "valid_to"))
    # lengths of a host's prefixes stand before all its changes
    lengths = prefixes.groupBy("host").agg(F.collect_set(F.length("prefix")).alias("lengths")).withColumn("time", F.lit("0001-01-01").cast("timestamp"))
    every = lines.unionByName(lengths, allowMissingColumns=True)
    salt = lambda parts: F.explode(F.sequence(F.lit(0), parts - 1)).alias("salt")
    dealt = lambda changes: changes.join(hosts, "host").select(*changes.columns, salt(F.col("parts")))

    # only hosts of several parts need be known before the merge
    wide = seen.join(listed(hosts.filter("parts > 1")), "host", "left")
    salted = wide.withColumn("salt", F.pmod(F.xxhash64("key", "path", "at"), F.coalesce("parts", F.lit(1))).cast("int"))
    dated = "host != '' and at is not null"
    found = _as_of(salted.filter(dated), dealt(every), ["host", "salt"], "at", ["n_own", "first_own", "lengths"])
    undated = salted.filter(f"not coalesce({dated}, false)")
    found = found.unionByName(undated, allowMissingColumns=True).select("key", "host", "path", "at", "salt", F.coalesce("n_own", F.lit(0)).alias("n_own"), F.nullif("first_own", F.lit("")).alias("first_own"), "lengths")
    if prefixes.isEmpty():
        found = found.withColumns({"n_prefix": F.lit(0), "first_prefix": F.lit(None).cast("string")})
    else:
        cut = found.filter("lengths is not null and at is not null").select("host", "path", "at", "salt", "lengths").distinct()
        cut = cut.withColumn("length", F.explode("lengths")).filter(F.length("path") >= F.col("length")).select("host", "path", "at", "salt", F.substring("path", F.lit(1), F.col("length")).alias("prefix"))
        cut = cut.join(listed(prefixes.select("host", "prefix", "name").distinct()), ["host", "prefix"])
        then = _as_of(cut, dealt(_changes(prefixes, "host", "prefix", "name")), ["host", "prefix", "name", "salt"], "at", ["active"])
        hits = then.filter("active").groupBy("host", "path", "at", "salt").agg(F.count("*").cast("int").alias("n_prefix"), F.min("name").alias("first_prefix"))
        found = found.join(hits, ["host", "path", "at", "salt"], "left")
    n = F.col("n_own") + F.coalesce("n_prefix", F.lit(0))
    return found.select(F.col("key").alias(key), "host", (n > 0).alias("blocked"), n.cast("int").alias("n_rules"), F.least("first_own", "first_prefix").alias("first_rule"))
