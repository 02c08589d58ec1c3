"""Page filter: rules on host and path, and trust that spreads over the links between hosts.

Pages that a rule allows or blocks are seeds. Three personalised PageRanks run over the host graph together:
trust (allowed pages) and a neutral one (pages without a rule) flow along the links, distrust (blocked pages)
flows against them, from a host to those that link to it. A host is blocked where distrust makes up too large a
share of the three. Links are the absolute targets in a page's markup, weighted by the pages that have them; a
host and its parent domain are linked both ways, as one owner holds both.

Masses are whole millionths of a page and every step rounds down, so sums do not depend on their order and the
result is the same on every cluster. A round is one join on the sending host and one combining sum; edges
between two hosts are one row, so a hub costs rows per neighbour, not per link, and adaptive execution splits
its join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewheel.llm.common import bounded, stored

RULES = (("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"), ("net/es/", "block"), ("net/fr/", "block"))
#: A link target with a host, in any attribute that loads or leads to it.
LINK = r"""(?:[hH][rR][eE][fF]|[sS][rR][cC]|[aA][cC][tT][iI][oO][nN])[ \t\r\n]*=[ \t\r\n]*["']?[ \t\r\n]*(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//([^/?#"' \t\r\n<>]+)"""
UNIT = 1_000_000
FOLLOW = 0.85
ROUNDS = 20
#: Percent of distrust in a host's mass from which it is blocked.
BLOCK_AT = 50
KINDS = ("trust", "neutral", "distrust")
#: Hosts that are broadcast with what is known of them, at most.
HOSTS = 100_000
#: Rounds that run before their masses are written.
CHAIN = 5


def lowered(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def parsed(pages: DataFrame) -> DataFrame:
    """page_id, host, path and linked, the distinct hosts that the markup names in links."""
    part = lambda k: F.coalesce(F.regexp_extract("url", r"(?s)^.*?://([^/?#]*)([^?#]*)", k), F.lit(""))
    linked = F.array_distinct(F.transform(F.regexp_extract_all("html", F.lit(LINK), 1), lowered))
    return pages.select(F.col("page_id").cast("long").alias("page_id"), lowered(part(1)).alias("host"), part(2).alias("path"), F.coalesce(linked, F.array().cast("array<string>")).alias("linked"))


def by_rule(pages: DataFrame, rules: DataFrame) -> DataFrame:
    """The pages (host, path) with the longest rule that fits, and its verdict; rules are (rule, verdict)."""
    at = F.instr("rule", "/")
    rules = rules.select("rule", "verdict", F.expr("substring(rule, 1, instr(rule, '/') - 1)").alias("suffix"), F.expr("substring(rule, instr(rule, '/'))").alias("begins")).where(at > 0)
    labels = F.split("host", r"\.", -1)
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda k: F.array_join(F.slice(labels, k, F.size(labels)), "."))
    hosts = pages.select("host").distinct().select("host", F.explode(suffixes).alias("suffix"))
    fits = hosts.join(F.broadcast(rules) if rules.count() <= HOSTS else rules, "suffix")
    known = fits.groupBy("host").agg(F.sort_array(F.collect_list(F.struct(F.length("rule").alias("size"), "rule", "verdict", "begins")), asc=False).alias("fits"))
    joined = pages.join(bounded(stored(known, "host-rules"), HOSTS), "host", "left")
    best = F.get(F.filter("fits", lambda r: F.startswith(F.col("path"), r["begins"])), F.lit(0))
    return joined.withColumn("best", best).select(*pages.columns, F.col("best.rule").alias("rule"), F.col("best.verdict").alias("verdict"))


def links_between(pages: DataFrame) -> DataFrame:
    """(src, dst, weight): pages of one host that link to another, and a host and its parent domain both ways."""
    named = pages.where("host <> ''").select("host", F.explode("linked").alias("dst")).where("host <> dst").groupBy("host", "dst").agg(F.count("*").alias("weight"))
    labels = F.split("host", r"\.", -1)
    above = lambda k: F.array_join(F.slice(labels, k, F.size(labels)), ".")
    steps = F.when(F.size(labels) > 2, F.transform(F.sequence(F.lit(1), F.size(labels) - 2), lambda k: F.struct(above(k).alias("low"), above(k + 1).alias("high"))))
    kin = pages.where("host <> ''").select("host").distinct().select(F.explode(steps).alias("k")).select("k.low", "k.high").distinct()
    both = kin.select(F.explode(F.array(F.struct(F.col("low").alias("src"), F.col("high").alias("dst")), F.struct(F.col("high").alias("src"), F.col("low").alias("dst")))).alias("e"))
    rows = named.select(F.col("host").alias("src"), "dst", "weight").union(both.select("e.src", "e.dst", F.lit(1).cast("long")))
    return rows.groupBy("src", "dst").agg(F.sum("weight").alias("weight"))


def _roads(links: DataFrame) -> DataFrame:
    """(of, to, along, against): the share of a host's mass that goes to another along links, and against."""
    out = links.groupBy("src").agg(F.sum("weight").alias("out"))
    into = links.groupBy("dst").agg(F.sum("weight").alias("into"))
    both = links.join(out, "src").join(into, "dst")
    along = both.select(F.col("src").alias("of"), F.col("dst").alias("to"), (F.col("weight") / F.col("out")).alias("along"), F.lit(0.0).alias("against"))
    against = both.select(F.col("dst").alias("of"), F.col("src").alias("to"), F.lit(0.0).alias("along"), (F.col("weight") / F.col("into")).alias("against"))
    return along.union(against).groupBy("of", "to").agg(F.max("along").alias("along"), F.max("against").alias("against"))


def propagate(seeds: DataFrame, links: DataFrame, *, follow: float = FOLLOW, rounds: int = ROUNDS) -> DataFrame:
    """(host, trust, neutral, distrust) after ``rounds`` rounds, from seeds of these columns and links (src, dst,
    weight). What a host without links would pass on ends there. After 20 rounds less than 4 % of a walk remains."""
    roads = bounded(stored(_roads(links), "roads"), HOSTS)
    restart = stored(seeds.select("host", *[F.floor(F.col(k) * (1 - follow)).alias(k) for k in KINDS]), "restart")
    mass, seen = restart, None
    for k in range(1, rounds + 1):
        share = {"trust": "along", "neutral": "along", "distrust": "against"}
        sent = mass.withColumnRenamed("host", "of").join(roads, "of")
        sent = sent.select(F.col("to").alias("host"), *[F.floor(F.col(c) * F.lit(follow) * F.col(share[c])).alias(c) for c in KINDS])
        mass = restart.union(sent).groupBy("host").agg(*[F.sum(c).alias(c) for c in KINDS])
        if k % CHAIN == 0 and k < rounds:
            mass = stored(mass, "mass")
            state = tuple(mass.agg(F.bit_xor(F.xxhash64("host", *KINDS))).first())
            if state == seen:
                break
            seen = state
    return stored(mass, "mass")


def judge(pages: DataFrame, rules: DataFrame, *, follow: float = FOLLOW, rounds: int = ROUNDS, block_at: int = BLOCK_AT) -> DataFrame:
    """page_id, host, path, rule, verdict and the masses of the host of every page (page_id, url, html).

    A rule ``host/path`` fits its host and all subdomains where the page's path begins with its path; the longest
    wins. Elsewhere the host decides: block where at least ``block_at`` percent of its mass is distrust. A null
    url, or one without ``://``, has an empty host and path, fits no rule, takes no part in the graph, and is
    allowed, with null masses. A null or empty html has no links. Links to the own host do not count. Repeated
    rows count and come back each; an empty table gives no rows; other columns are ignored.
    """
    placed = stored(by_rule(parsed(pages), rules), "placed")
    is_kind = {"trust": F.col("verdict") == "allow", "neutral": F.col("verdict").isNull(), "distrust": F.col("verdict") == "block"}
    seeds = placed.where("host <> ''").groupBy("host").agg(*[(F.count(F.when(c, 1)) * UNIT).alias(k) for k, c in is_kind.items()])
    mass = propagate(seeds, stored(links_between(placed), "links"), follow=follow, rounds=rounds)
    bad = F.col("distrust") * 100 >= (F.col("trust") + F.col("neutral") + F.col("distrust")) * block_at
    joined = placed.drop("linked").join(bounded(mass, HOSTS), "host", "left")
    verdict = F.coalesce("verdict", F.when(bad, F.lit("block")).otherwise(F.lit("allow")))
    return joined.select("page_id", "host", "path", "rule", verdict.alias("verdict"), *KINDS)


def op11_link_trust(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(list(RULES), "rule string, verdict string")
    return judge(spark.read.parquet(f"{sf_dir}/pages.parquet"), rules)


def _rounds_sql() -> str:
    out = []
    for k in range(1, ROUNDS + 1):
        sent = ", ".join(f"CAST(floor(m.{c} * CAST({FOLLOW} AS DOUBLE) * r.{'against' if c == 'distrust' else 'along'}) AS BIGINT) AS {c}" for c in KINDS)
        sums = ", ".join(f"CAST(sum({c}) AS BIGINT) AS {c}" for c in KINDS)
        out.append(f"""mass_{k} AS MATERIALIZED (
  SELECT host, {sums} FROM (SELECT * FROM restart UNION ALL SELECT r.dst AS host, {sent} FROM mass_{k - 1} m JOIN roads r ON r.src = m.host) GROUP BY host
)""")
    return ", ".join(out)


_RULES_SQL = ", ".join(f"('{r}', '{v}', '{r[: r.index('/')]}', '{r[r.index('/') :]}')" for r, v in RULES)
#: The same masses, round by round.
OP11_SQL = rf"""
WITH parsed AS (
  SELECT row_number() OVER () AS row, page_id,
         translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path,
         list_distinct(list_transform(regexp_extract_all(html, '{LINK.replace("'", "''")}', 1), lambda h: translate(h, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'))) AS linked
  FROM pages
), fits AS (
  SELECT p.row, r.rule, r.verdict, row_number() OVER (PARTITION BY p.row ORDER BY length(r.rule) DESC) AS place
  FROM parsed p JOIN (VALUES {_RULES_SQL}) r(rule, verdict, host, path)
    ON (p.host = r.host OR ends_with(p.host, '.' || r.host)) AND starts_with(p.path, r.path)
), placed AS MATERIALIZED (
  SELECT p.*, f.rule, f.verdict FROM parsed p LEFT JOIN fits f ON f.row = p.row AND f.place = 1
), seeds AS (
  SELECT host, count(*) FILTER (verdict = 'allow') AS trust, count(*) FILTER (verdict IS NULL) AS neutral, count(*) FILTER (verdict = 'block') AS distrust
  FROM placed WHERE host <> '' GROUP BY host
), restart AS MATERIALIZED (
  SELECT host, {', '.join(f'CAST(floor({c} * {UNIT} * (1 - CAST({FOLLOW} AS DOUBLE))) AS BIGINT) AS {c}' for c in KINDS)} FROM seeds
), labels AS (
  SELECT DISTINCT host, string_split(host, '.') AS parts FROM placed WHERE host <> ''
), kin AS (
  SELECT DISTINCT array_to_string(parts[k : len(parts)], '.') AS low, array_to_string(parts[k + 1 : len(parts)], '.') AS high
  FROM labels, unnest(range(1, greatest(len(parts) - 1, 1))) t(k)
), links AS (
  SELECT src, dst, CAST(sum(weight) AS BIGINT) AS weight FROM (
    SELECT host AS src, dst, count(*) AS weight FROM (SELECT host, unnest(linked) AS dst FROM placed) WHERE host <> '' AND host <> dst GROUP BY host, dst
    UNION ALL SELECT low, high, 1 FROM kin UNION ALL SELECT high, low, 1 FROM kin
  ) GROUP BY src, dst
), roads AS MATERIALIZED (
  SELECT src, dst, max(along) AS along, max(against) AS against FROM (
    SELECT src, dst, weight / CAST(sum(weight) OVER (PARTITION BY src) AS DOUBLE) AS along, 0.0::DOUBLE AS against FROM links
    UNION ALL SELECT dst, src, 0.0::DOUBLE, weight / CAST(sum(weight) OVER (PARTITION BY dst) AS DOUBLE) FROM links
  ) GROUP BY src, dst
), mass_0 AS (SELECT * FROM restart), {_rounds_sql()}
SELECT p.page_id, p.host, p.path, p.rule,
       coalesce(p.verdict, CASE WHEN m.distrust * 100 >= (m.trust + m.neutral + m.distrust) * {BLOCK_AT} THEN 'block' ELSE 'allow' END) AS verdict,
       {', '.join(f'm.{c}' for c in KINDS)}
FROM placed p LEFT JOIN mass_{ROUNDS} m USING (host)
"""
