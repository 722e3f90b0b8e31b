"""Closest names for headers of many columns: an inverted index of q-grams instead of all pairs of names.

A pair scores 1.0 by alias, 0.9 when one name holds the other, else by edit distance. Every pair of ``SETTLED`` or more is
reached through one of the keys below, so a best score of that much is the best of all pairs:

* ``n`` and ``a``: the other name, or its field, is the alias of this one.
* ``i`` and ``r``: a name inside another shares all its pairs of neighbouring letters with it, thus its rarest one.
* ``p``: of names of length x, an edit spoils two of the x + 1 padded pairs of letters. A score of 0.8 leaves at most x / 4
  edits, so among any 2 * floor(x / 4) + 1 of them, here the rarest, one is in the other name as well.

What is left has no close name; it is compared with all added names in blocks of bounded size, of which only those whose
length alone does not rule out a better score are looked at. Lists of names are cut by a hash, so neither a row nor a task
holds all names of a feed, and results are one row per removed name and list, never a row per pair.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.functions.names import drift_score

#: Score from which the index is known to reach every pair (a fixed property of the keys).
SETTLED = 0.8
_KEY = ["feed", "from"]


def _padded(folded: Column) -> Column:
    """Pairs of neighbouring letters with one mark before and one behind, numbered where a pair comes again."""
    text = F.concat(F.lit("\x01"), folded, F.lit("\x02"))
    pairs = F.transform(F.sequence(F.lit(1), F.char_length(folded) + 1), lambda i: F.substr(text, i, F.lit(2)))
    return F.transform(pairs, lambda p, i: F.concat(
        F.lit("p"), p, F.size(F.filter(F.slice(pairs, 1, i + 1), lambda x: x == p)).cast("string")))


def _letters(folded: Column) -> Column:
    """Different pairs of neighbouring letters and single letters."""
    singles = F.filter(F.split(folded, ""), lambda c: c != "")
    places = F.when(F.char_length(folded) > 1, F.sequence(F.lit(1), F.char_length(folded) - 1)).otherwise(
        F.array().cast("array<int>"))
    return F.array_distinct(F.concat(singles, F.transform(places, lambda i: F.substr(folded, i, F.lit(2)))))


def _rarest(names: DataFrame, grams: Column, counts: DataFrame, most: Column) -> DataFrame:
    """The ``most`` rarest of each name's grams by ``counts`` of (feed, key); a gram that is not counted is rarest."""
    each = names.select("feed", "name", most.alias("_most"), F.explode(F.array_distinct(grams)).alias("key"))
    ranked = each.join(counts, ["feed", "key"], "left").withColumn("_rank", F.row_number().over(
        Window.partitionBy("feed", "name").orderBy(F.coalesce("n", F.lit(0)), "key")))
    return ranked.filter(F.col("_rank") <= F.col("_most")).select("feed", "name", "key")


def _inside(folded: Column) -> Column:
    """Grams by which a name is looked for inside others: its pairs of letters, its letter, or nothing."""
    own = F.filter(_letters(folded), lambda g: F.char_length(g) == F.least(F.char_length(folded), F.lit(2)))
    return F.when(F.char_length(folded) > 0, own).otherwise(F.array(F.lit("")))


def _tagged(tag: str, grams: Column) -> Column:
    return F.transform(grams, lambda g: F.concat(F.lit(tag), g))


def best_of(removed: Column, names: Column) -> Column:
    """The best of a list of added names; of equal scores the earlier column."""
    return F.array_max(F.transform(names, lambda a: F.struct(
        drift_score(removed, a["name"]).alias("score"), (-a["pos"]).alias("rank"), a["name"]["name"].alias("to"))))


def closest(removed: DataFrame, added: DataFrame, lists: int) -> DataFrame:
    """(feed, from, best) of every removed name: ``best`` is (score, rank, to), null when nothing was added.

    ``removed`` has feed and name, ``added`` feed, pos and name (as ``drift_name`` gives it); the names of a feed are kept
    in ``lists`` lists each.
    """
    salt = F.pmod(F.xxhash64("name.name"), F.lit(lists))
    entry = F.struct("pos", "name").alias("entry")
    folded = F.col("name.folded")
    spread = added.select("feed", "name", salt.alias("salt"), entry)

    keys = spread.select("feed", "salt", "entry", F.explode(F.array_distinct(F.concat(
        _padded(folded), _tagged("i", _letters(folded)), F.array(F.concat(F.lit("n"), "name.name")),
        F.when(F.col("name.alias").isNotNull(), F.array(F.concat(F.lit("a"), "name.alias"))).otherwise(F.array().cast("array<string>")),
    ))).alias("key"))
    counts = keys.groupBy("feed", "key").agg(F.count(F.lit(1)).alias("n"))
    homes = _rarest(added, _tagged("i", _inside(folded)), counts, F.lit(1)).select(
        "feed", "name", F.concat(F.lit("r"), F.substring("key", 2, 1 << 20)).alias("key"))
    homes = homes.join(spread.select("feed", F.col("name.name").alias("_to"), "salt", "entry"), (
        homes["feed"] == spread["feed"]) & (F.col("name.name") == F.col("_to"))).select(homes["feed"], "salt", "entry", "key")
    index = keys.unionByName(homes).groupBy("feed", "key", "salt").agg(F.collect_list("entry").alias("entries"))

    padded = _rarest(removed, _padded(folded), counts, 2 * F.floor(F.char_length(folded) / 4) + 1)
    inside = _rarest(removed, _tagged("i", _inside(folded)), counts, F.lit(1))
    others = removed.select("feed", "name", F.explode(F.concat(
        _tagged("r", F.array_append(_letters(folded), "")), F.array(F.concat(F.lit("a"), "name.name")),
        F.when(F.col("name.alias").isNotNull(), F.array(F.concat(F.lit("n"), "name.alias"))).otherwise(F.array().cast("array<string>")),
    )).alias("key"))
    probes = padded.unionByName(inside).unionByName(others)

    near = probes.join(index, ["feed", "key"]).groupBy("feed", F.col("name").alias("from")).agg(
        F.max(best_of(F.col("name"), F.col("entries"))).alias("best"))
    judged = removed.select("feed", F.col("name").alias("from")).join(near, _KEY, "left")
    # An empty name is inside every other one, so only an alias settles it.
    size = F.char_length("from.folded")
    settled = F.coalesce(F.col("best.score") >= F.when(size > 0, F.lit(SETTLED)).otherwise(1.0), F.lit(False))

    # One row per list is enough to score a name against all names of it.
    blocks = spread.groupBy("feed", "salt").agg(F.collect_list("entry").alias("entries"))

    def hopeful(e: Column) -> Column:
        other = F.char_length(e["name"]["folded"])
        most = F.least(size, other) / F.greatest(size, other, F.lit(1))
        # 1/3 and 1 - 2/3 differ in their last digit; a tie must not be lost to that.
        return (size == 0) | (other == 0) | (most + 1e-9 >= F.coalesce(F.col("best.score"), F.lit(0.0)))

    rest = judged.filter(~settled).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(lists - 1)).cast("array<bigint>")))
    rest = rest.join(blocks, ["feed", "salt"], "left").groupBy(*_KEY).agg(
        F.max(best_of(F.col("from"), F.filter("entries", hopeful))).alias("best"))
    return judged.filter(settled).unionByName(rest).select("feed", F.col("from.name").alias("from"), "best")
