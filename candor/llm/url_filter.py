"""URL verdicts from host-and-path lists held in Bloom filter cascades."""

from __future__ import annotations

import json
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candor.session import stored

# The rules by verdict, and the listed hosts for urls that no rule fits.
RULES = {
    "block": ("net/", "example.com/de/"),
    "allow": ("example.net/en/", "org/fr/"),
}
LISTED_HOSTS = (
    "ads-track.example.com", "ads-track.example.net", "ads-track.example.org",
    "casino-win.example.com", "casino-win.example.net", "casino-win.example.org",
    "free-bets.example.com", "free-bets.example.net", "free-bets.example.org",
    "spam-farm.example.com", "spam-farm.example.net", "spam-farm.example.org",
)
Listed = DataFrame | list[str] | tuple[str, ...]  # a table has its keys in the column ``key``
_WORD = 64
_MIN_BITS = 64
_MAX_LEVELS = 200
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; null or without ``://``: empty."""
    return F.coalesce(F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), _UPPER, _LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """From the end of the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _shape(key: str) -> tuple[int, int]:
    """How many host labels and path characters a listed key has."""
    host, slash, path = key.partition("/")
    return host.count(".") + 1, len(slash + path)


def shapes_of(listed: Listed) -> list[tuple[int, int]]:
    """The (labels, path length) shapes of a list, most labels first: of a table, as many as its hosts have label counts."""
    if isinstance(listed, DataFrame):
        host, slash = F.substring_index("key", "/", 1), F.length("key") - F.length(F.substring_index("key", "/", 1))
        own = listed.where("key IS NOT NULL").select(F.size(F.split(host, r"\.")).alias("n"), slash.alias("c")).distinct().collect()
        return sorted(((r.n, r.c) for r in own), key=lambda s: (-s[0], -s[1]))
    return sorted({_shape(k) for k in listed}, key=lambda s: (-s[0], -s[1]))


def candidates(host: Column, path: Column, shapes: list[tuple[int, int]]) -> Column:
    """Every key of the url that could be listed: host suffixes on label borders with path prefixes.

    Only the shapes that the list has are formed. A host or path shorter than a
    shape gives a shorter key, which is a true suffix and prefix of the url all
    the same.
    """
    if not shapes:
        return F.array().cast("array<string>")
    keys = F.array_distinct(F.array(*[
        F.concat(F.substring_index(host, ".", -labels), F.substring(path, 1, chars)) for labels, chars in shapes]))
    return F.when(host == "", F.array().cast("array<string>")).otherwise(keys)


def _bit(key: Column, level: int, probe: int, bits: int) -> Column:
    return F.pmod(F.xxhash64(key, F.lit(level), F.lit(probe)), F.lit(bits))


class BloomCascade:
    """Exact membership of the keys of a known universe, as a few small bit arrays.

    Level 1 holds the listed keys, level 2 the other keys of the universe that
    pass level 1, level 3 the listed keys that pass level 2, and so on until no
    key passes wrongly. A key is listed if the first level it fails is even.
    Total size is a few times ``listed * log2(universe / listed)`` bits: it
    follows the list, and the universe only by its logarithm.
    """

    def __init__(self, universe: DataFrame, listed: Listed):
        """``universe(key)`` has every key that will ever be asked, repeats allowed; listed keys outside it take no room."""
        spark = universe.sparkSession
        self.levels: list[tuple[int, int, str]] = []  # bits, probes, words as JSON
        marks = universe.select("key", F.lit(False).alias("listed"), F.lit(True).alias("asked"))
        if isinstance(listed, DataFrame):
            own = listed.select("key")
        else:
            all_keys = F.from_json(F.lit(json.dumps(sorted(set(listed)))), "array<string>")
            own = spark.range(1).select(F.explode(all_keys).alias("key"))
        marks = marks.unionByName(own.select("key", F.lit(True).alias("listed"), F.lit(False).alias("asked")))
        keys = stored(marks.where("key IS NOT NULL").groupBy("key").agg(F.max("listed").alias("listed"), F.max("asked").alias("asked"))
                      .where("asked").select("key", "listed"), "universe")
        counts = keys.agg(F.count_if("listed").alias("inside"), F.count_if(~F.col("listed")).alias("outside")).first()
        inside, outside, side = counts.inside, counts.outside, True
        rate = min(0.5, inside * math.sqrt(0.5) / max(outside, 1))
        self.empty = inside == 0
        while not self.empty:
            n = inside if side else outside
            if n == 0:
                break
            if len(self.levels) >= _MAX_LEVELS:
                raise RuntimeError("two keys share all hashes")
            self._add(keys.where(F.col("listed") == side), n, rate)
            # Keys of the encoded side stay; of the other side those that pass wrongly.
            wrong = (F.col("listed") != side) & self._passes(F.col("key"), len(self.levels) - 1)
            keys = stored(keys.where((F.col("listed") == side) | wrong), "cascade")
            counts = keys.groupBy("listed").count().collect()
            inside, outside = (sum(r["count"] for r in counts if r.listed == want) for want in (True, False))
            side, rate = not side, 0.5

    def _add(self, keys: DataFrame, n: int, rate: float) -> None:
        bits = max(_MIN_BITS, _WORD * math.ceil(n * -math.log(rate) / math.log(2) ** 2 / _WORD))
        probes = max(1, round(-math.log2(rate)))
        level = len(self.levels)
        at = F.explode(F.array(*[_bit(F.col("key"), level, j, bits) for j in range(probes)])).alias("at")
        words = (keys.select(at).groupBy(F.shiftright("at", 6).alias("word"))
                 .agg(F.bit_or(F.expr("shiftleft(1L, cast(at & 63 AS int))")).alias("mask")).collect())
        full = [0] * (bits // _WORD)
        for r in words:
            full[r.word] = r.mask
        self.levels.append((bits, probes, json.dumps(full)))

    def _passes(self, key: Column, level: int) -> Column:
        bits, probes, words = self.levels[level]
        array = F.from_json(F.lit(words), "array<bigint>")
        found = F.lit(True)
        for j in range(probes):
            at = _bit(key, level, j, bits)
            word = F.get(array, F.shiftright(at, 6).cast("int"))
            found = found & (F.bit_get(word, at.bitwiseAND(F.lit(63)).cast("int")) == 1)
        return found

    def contains(self, key: Column) -> Column:
        """Whether ``key``, of the universe, is listed."""
        answer = F.lit(len(self.levels) % 2 == 1)
        for level in reversed(range(len(self.levels))):
            answer = F.when(self._passes(key, level), answer).otherwise(F.lit(level % 2 == 1))
        return answer


def url_verdicts(pages: DataFrame, rules: dict[str, tuple[str, ...]] = RULES,
                 hosts: Listed = LISTED_HOSTS) -> DataFrame:
    """``page_id, host, path, rule, verdict, listed`` for every row.

    A rule is ``host/path-prefix``; it fits its host and all subdomains, and the
    longest that fits wins (of equal length, the later in text order). Without a rule the method decides: a url whose host
    or a parent of it is in ``hosts`` is blocked, any other is allowed. ``hosts``
    may be a table with the column ``key``, of any size: it meets the urls' keys
    in one aggregate, and only hosts that occur among them take room. ``listed``
    tells of that membership in either case. A null url, or one without ``://``,
    has an empty host and path, fits nothing and is allowed. Repeated rows are
    judged each; other columns are not read; an empty table gives an empty table.
    """
    clash = {k for k in rules.get("block", ()) if k in rules.get("allow", ())}
    if clash:
        raise ValueError(f"rules with two verdicts: {sorted(clash)}")
    block, allow = list(rules.get("block", ())), list(rules.get("allow", ()))
    rows = pages.select("page_id", host_of(pages.url).alias("host"), path_of(pages.url).alias("path"))
    host, path = F.col("host"), F.col("path")
    keys = candidates(host, path, shapes_of(block + allow))
    host_keys = candidates(host, F.lit(""), shapes_of(hosts))
    universe = stored(rows.select(F.explode(F.array_union(keys, host_keys)).alias("key")).distinct(), "url-keys")
    blocked, allowed, bad = (BloomCascade(universe, x) for x in (block, allow, hosts))
    fits = F.filter(keys, lambda k: blocked.contains(k) | allowed.contains(k))
    rule = F.array_max(F.transform(fits, lambda k: F.struct(F.length(k).alias("n"), k.alias("k"))))["k"]
    judged = rows.withColumn("rule", rule).withColumn("listed", F.exists(host_keys, bad.contains))
    by_rule = F.when(blocked.contains(F.col("rule")), "block").when(F.col("rule").isNotNull(), "allow")
    return judged.select("page_id", "host", "path", "rule", F.coalesce(
        by_rule, F.when(F.col("listed"), "block").otherwise("allow")).alias("verdict"), "listed")
