"""Crowd-sourced price rounds: averages, votes and settlement, status, link chains, the wide table."""

from __future__ import annotations

import functools
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.numeric import decimal_comma, exact_avg, exact_sum, price_number
from ..functions.payload import table_rows, unnest
from ..session import written
from .project import keep_listed
from .snapshot import first_per_group

# Audit states of a round, the share of a stake that is lost, sample sizes, the round table's axes.
PAID = "PayoutSuccessful"
FAILED = "PayoutFailed"
UNINITIALIZED = "Uninitialized"
SLASHED_SHARE = 0.7
AUDIT_SAMPLE = 5
PROOF_DRAWS = 4
CITIES = ["Denver", "Boston", "Brooklyn", "Chicago", "Seattle", "Miami", "Washington, D.C.", "Los Angeles"]
CATEGORIES = ["Economy", "Compact", "Intermediate", "Standard", "Standard SUV"]


def yearly_sum(df: DataFrame, value: str, year: str = "year", scale: int | None = None) -> DataFrame:
    """Sum per year of numbers written with a decimal comma; `scale` makes the sum independent of row order."""
    number = decimal_comma(F.col(value).cast("string"))
    total = F.sum(number) if scale is None else exact_sum(number, scale)
    return df.groupBy(year).agg(total.alias(value))


def records_of_round(df: DataFrame, kind: str, round_id: int | str, column: str = "id") -> DataFrame:
    """Records whose id starts with `kind:round:`; the prefix test reaches the scan."""
    return df.where(F.col(column).startswith(f"{kind}:{round_id}:"))


def recent_rounds(df: DataFrame, lookback: int = 7, min_round: int = 14, column: str = "round") -> DataFrame:
    """The newest round and up to `lookback` rounds before it, none below `min_round`."""
    oldest = df.agg(F.max(column) - lookback).scalar()
    return df.where((F.col(column) >= oldest) & (F.col(column) >= min_round))


def scrape_prices(df: DataFrame, round_column: str = "round", summary: str = "locationSummary") -> DataFrame:
    """`locationSummary` arrays of (location, {type: price}) as one row per price."""
    places = unnest(df, [round_column], F.col(summary))
    return places.select(round_column, "location", F.explode("data").alias("type", "price"))


def scraped_prices(
    pages: DataFrame, keys: list[str], html: str, row_pattern: str, type_pattern: str, price_pattern: str,
    types: Iterable[str] = tuple(CATEGORIES),
) -> DataFrame:
    """Prices in the table rows of scraped pages, allowed types only; the last row of a type counts."""
    cells = table_rows(F.col(html), row_pattern, {"type": type_pattern, "price": price_pattern})
    numbered = F.transform(cells, lambda cell, n: F.struct(n.alias("n"), cell["type"].alias("type"), cell["price"].alias("price")))
    rows = keep_listed(unnest(pages, keys, numbered), "type", types)
    return rows.groupBy(*keys, "type").agg(price_number(F.max_by("price", "n")).alias("price"))


def round_average(prices: DataFrame, round_column: str = "round", scale: int | None = None) -> DataFrame:
    """Average price by round, location and type; partial sums keep a hot round from being one task."""
    mean = F.avg("price") if scale is None else exact_avg(F.col("price"), scale)
    return prices.groupBy(round_column, "location", "type").agg(mean.alias("price"))


def vote_tally(votes: DataFrame) -> DataFrame:
    """Net votes and their number by round and candidate: a valid vote counts +1, any other −1."""
    return votes.groupBy("round", "key").agg(
        F.sum(F.when(F.col("is_valid"), 1).otherwise(-1)).alias("net"), F.count(F.lit(1)).alias("votes")
    )


def settlement(
    submissions: DataFrame, triggers: DataFrame, votes: DataFrame, stakes: DataFrame, bounty: Column
) -> DataFrame:
    """What each candidate of a round gains or loses.

    Without an audit trigger, or with a positive net vote, a candidate shares the round's bounty (rounded down).
    A trigger without votes or with a negative net vote costs 70% of the stake. A tie gives no row. `bounty` is a
    literal or a function of `round`. Submissions, triggers and votes meet in one hash aggregation, and the number
    of eligible candidates comes from a partial aggregate, not from a window: a round with very many submissions is
    not gathered in one task.
    """
    keys = ["round", "key"]
    def marked(df: DataFrame, mark: str, vote: Column = F.lit(None)) -> DataFrame:
        return df.select(*keys, F.lit(mark).alias("_mark"), vote.cast("int").alias("_vote"))

    vote = F.when(F.col("is_valid"), 1).otherwise(-1)
    rows = marked(submissions, "s").unionAll(marked(triggers, "t")).unionAll(marked(votes, "v", vote))
    # Said here, because the join below would add the test to one of its inputs only, and then the shuffle of these
    # rows could not be shared by the three uses of the result.
    named = rows.where(F.col("round").isNotNull() & F.col("key").isNotNull())
    judged = named.groupBy(*keys).agg(
        F.max(F.col("_mark") == "s").alias("_submitted"),
        F.max(F.col("_mark") == "t").alias("_audited"),
        F.sum("_vote").alias("net"),
    )
    # Without any vote the sum is null, and an audited candidate then loses like one with a negative sum.
    outcome = F.when(~F.col("_audited") | (F.col("net") > 0), "reward").when(
        F.coalesce("net", F.lit(-1)) < 0, "slash"
    )
    decided = judged.where("_submitted").select(*keys, outcome.alias("outcome")).where(F.col("outcome").isNotNull())
    shares = decided.where(F.col("outcome") == "reward").groupBy("round").agg(F.count(F.lit(1)).alias("_eligible"))
    rewarded = decided.where(F.col("outcome") == "reward").join(shares, "round").select(
        *keys, "outcome", F.floor(bounty / F.col("_eligible")).cast("double").alias("amount")
    )
    slashed = decided.where(F.col("outcome") == "slash").join(stakes.select("key", "stake"), "key", "left").select(
        *keys, "outcome", (-(F.col("stake") * F.lit(SLASHED_SHARE))).cast("double").alias("amount")
    )
    return rewarded.unionAll(slashed)


def latest_success(records: DataFrame) -> DataFrame:
    """One row: the newest round that was paid (null if none), and the newest that did not fail (0 if none)."""
    status = F.col("status")
    return records.agg(
        F.max(F.when(status == PAID, F.col("round"))).alias("latest_paid"),
        F.coalesce(F.max(F.when(status != FAILED, F.col("round"))), F.lit(0)).alias("latest_not_failed"),
    )


def open_rounds(records: DataFrame) -> DataFrame:
    """Failed and uninitialised rounds above the newest paid round, one row each."""
    paid = F.max(F.when(F.col("status") == PAID, F.col("round")))
    # Without a paid round all rounds are above it; one comparison with a subquery reaches the scan.
    newest = records.agg(F.coalesce(paid, F.min("round") - 1)).scalar()
    above = records.where(F.col("round") > newest)
    return above.where(F.col("status").isin(FAILED, UNINITIALIZED)).select("round", "status")


def latest_submission(df: DataFrame) -> DataFrame:
    """Per round the submission with the greatest slot, the smaller key on ties."""
    return first_per_group(df.select("round", "key", "slot"), ["round"], [F.desc_nulls_last("slot"), F.asc("key")])


def zero_key(df: DataFrame, key: str = "key", value: str = "value", group: str | None = None) -> DataFrame:
    """The first key whose value is zero, for the whole frame or per group."""
    first = F.min(F.when(F.col(value) == 0, F.col(key))).alias(key)
    return df.groupBy(group).agg(first) if group else df.agg(first)


def wide_rounds(
    prices: DataFrame,
    cities: Iterable[str] = tuple(CITIES),
    categories: Iterable[str] = tuple(CATEGORIES),
    round_column: str = "round",
    timestamp: str | None = None,
) -> DataFrame:
    """One row per round, one column per city and category; a missing price stays null.

    The column list is fixed, so there is one partial aggregation per round and no pass to find the columns. With
    `timestamp` every city also gets the text of its latest time.
    """
    columns = []
    for city in cities:
        here = F.col("city") == city
        columns += [
            F.max(F.when(here & (F.col("category") == category), F.col("price"))).alias(f"{city}-{category}")
            for category in categories
        ]
        if timestamp:
            latest = F.max(F.when(here, F.col(timestamp)))
            columns.append(F.date_format(latest, "yyyy-MM-dd HH:mm:ss").alias(f"{city}-timestamp"))
    return prices.groupBy(round_column).agg(*columns)


def fill_unfinished(current: DataFrame, unfinished: DataFrame, audits: DataFrame, data: DataFrame) -> DataFrame:
    """Current round data plus the data of unfinished rounds that have been paid since and are not there yet."""
    paid = unfinished.select("round").distinct().join(
        audits.where(F.col("status") == PAID).select("round").distinct(), "round", "left_semi"
    )
    late = data.join(paid, "round", "left_semi").join(current.select("round").distinct(), "round", "left_anti")
    return current.unionByName(late.select(*current.columns))


#: Walks of at most so many steps are taken step by step; longer ones over a contracted chain.
FEW_STEPS = 16
#: A payload is drawn for contraction with this chance, in each round anew. Contraction ends at this share of the links or so few links that
#: rounds cost more than they spare, or when a round takes out less than the least share.
DRAWN, CONTRACTED_TO, FEW_LINKS, LEAST_SHARE = 0.4, 1 / 64, 10_000, 0.04


def walk_chains(links: DataFrame, starts: DataFrame, bound: int = 0, include_root: bool = False) -> DataFrame:
    """Follow `prev_cid` from every start payload, one round lower per step, down to round `bound`.

    `links` has (cid, prev_cid), `starts` has (cid, round). The result has (start, round, cid). A walk ends at a
    payload without a link (kept only with `include_root`), at an unknown payload, or below the bound, which also
    ends cycles. A payload stored more than once counts once; of several links of one payload the least is followed.

    Few steps are joins with the same links, which are shuffled once for all of them. Long walks are list ranking: payloads
    between the starts are spliced out in rounds, the few links that stay are walked, and then every round's splices are put back, so
    the work is in proportion to the links and the rows of the result, whatever the distance.
    """
    begins = starts.where(F.col("round") >= bound).select(F.col("cid").alias("start"), "round", F.col("cid").alias("src")).distinct()
    farthest = (begins.agg(F.max("round")).first()[0] or bound) - bound
    if farthest < FEW_STEPS:
        return _step_by_step(_first_links(links, include_root), begins, farthest, bound)
    return _ranked(links, starts, begins, bound, include_root, farthest)


def _first_links(links: DataFrame, include_root: bool) -> DataFrame:
    """(src, dst): one link of each payload, the least; with `include_root` a root has a link to nowhere."""
    known = links.groupBy(F.col("cid").alias("src")).agg(F.min("prev_cid").alias("dst")).where(F.col("src").isNotNull())
    return known if include_root else known.where(F.col("dst").isNotNull())


def _step_by_step(linked: DataFrame, begins: DataFrame, farthest: int, bound: int) -> DataFrame:
    """All walks at once, a join per step; a row carries its walk so far, at most as long as there are steps.

    Walks that have ended have no next payload; the hash beside it in the join keeps them from meeting in one task.
    """
    found = linked.withColumn("_hash", F.xxhash64("src"))
    walks = begins.join(linked, "src").select("start", "round", F.array("src").alias("walk"), F.col("dst").alias("next"))
    for number in range(1, farthest + 1):
        onward = F.when(F.col("round") - number >= bound, F.col("next"))
        walks = walks.select("start", "round", "walk", onward.alias("next")).withColumn(
            "_hash", F.coalesce(F.when(F.col("next").isNotNull(), F.xxhash64("next")), F.xxhash64("start", "round"))
        )
        met = walks.join(found, (walks["_hash"] == found["_hash"]) & (walks["next"] == found["src"]), "left")
        walks = met.select("start", "round", F.when(F.col("src").isNull(), F.col("walk")).otherwise(F.array_append("walk", F.col("src"))).alias("walk"), F.col("dst").alias("next"))
    return walks.select("start", "round", F.posexplode("walk").alias("at", "cid")).select("start", (F.col("round") - F.col("at")).alias("round"), "cid")


def _heads(cid: Column, turn: int) -> Column:
    """Whether a payload is drawn in a round; a payload that is nowhere is not."""
    return F.coalesce(F.pmod(F.xxhash64(cid, F.lit(turn)), F.lit(1000)) < int(DRAWN * 1000), F.lit(False))


def _ranked(links: DataFrame, starts: DataFrame, begins: DataFrame, bound: int, include_root: bool, farthest: int) -> DataFrame:
    named = starts.select("cid", F.lit(None).cast(links.schema["prev_cid"].dataType).alias("prev_cid"), F.lit(False).alias("stored"))
    marked = links.select("cid", "prev_cid", F.lit(True).alias("stored")).unionAll(named).where(F.col("cid").isNotNull())
    found = marked.groupBy(F.col("cid").alias("src")).agg(
        F.min("prev_cid").alias("dst"), F.bool_or("stored").alias("stored"), F.bool_or(~F.col("stored")).alias("start")
    )
    chain = found.where("stored" if include_root else F.col("dst").isNotNull())
    chain = chain.select("src", "dst", "start", F.lit(1).cast("bigint").alias("len"), F.lit(0).alias("level"))
    parts = int(chain.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    turn = 0
    splices: list[DataFrame] = []
    chain = written(chain, "links")
    size = left = chain.count()
    while left > max(FEW_LINKS, size * CONTRACTED_TO):
        turn += 1
        seen = Observation()
        # A union has the parts of both sides, and a broadcast join keeps them, so their number would double with each round.
        step = _splice_out(chain, turn).coalesce(parts).observe(seen, F.count(F.when(~F.col("out"), 1)).alias("left"), F.count(F.when(F.col("out"), 1)).alias("out"))
        step = written(step.where(~F.col("out")).drop("out"), "splices")
        left, out = seen.get["left"], seen.get["out"]
        splices.append(step.where(F.col("via").isNotNull()).select(
            "src", "via", "src_len", "src_level", "via_level"
        ))
        chain = step.select("src", "dst", "start", "len", "level")
        if out <= LEAST_SHARE * (left + out):
            break
    rows = _doubled(chain, begins, bound, farthest)
    frames = [rows]
    for level in range(len(splices), 0, -1):
        mine = functools.reduce(DataFrame.unionAll, [f.where(F.col("level") == level) for f in frames]).coalesce(parts)
        back = mine.drop("level").join(splices[level - 1], "src")
        halves = F.inline(F.array(
            F.struct("start", "round", "src", F.col("src_level").alias("level")),
            F.struct("start", (F.col("round") - F.col("src_len")).alias("round"), F.col("via").alias("src"), F.col("via_level").alias("level")),
        ))
        frames.append(written(back.select(halves).where(F.col("round") >= bound), "walks"))
    whole = [f.where(F.col("level") == 0).select("start", F.col("round").cast(begins.schema["round"].dataType).alias("round"), F.col("src").alias("cid")) for f in frames]
    return functools.reduce(DataFrame.unionAll, whole)


def _splice_out(chain: DataFrame, turn: int) -> DataFrame:
    """One round: drawn payloads whose own link leads to one that is not drawn are `out`; links to them lead to where they led.

    Both draws are known from a payload's own link, so only links to drawn payloads and the links taken out are shuffled.
    """
    none = {"via": F.lit(None).cast(chain.schema["src"].dataType), "src_len": F.lit(None).cast("bigint"), "via_len": F.lit(None).cast("bigint"),
            "src_level": F.lit(None).cast("int"), "via_level": F.lit(None).cast("int")}
    out = _heads(F.col("src"), turn) & ~_heads(F.col("dst"), turn) & ~F.col("start")
    gone = chain.where(out)
    resting = chain.where(out | ~_heads(F.col("dst"), turn)).withColumns({**none, "out": out})
    taken = gone.select(F.col("src").alias("via"), F.col("dst").alias("far"), F.col("len").alias("via_len"), F.col("level").alias("via_level"))
    moving = chain.where(_heads(F.col("dst"), turn)).join(taken, F.col("dst") == F.col("via"), "left")
    passes = F.col("via").isNotNull()
    moved = moving.select(
        "src", F.when(passes, F.col("far")).otherwise(F.col("dst")).alias("dst"), "start",
        F.when(passes, F.col("len") + F.col("via_len")).otherwise(F.col("len")).alias("len"),
        F.when(passes, F.lit(turn)).otherwise(F.col("level")).alias("level"),
        "via", F.when(passes, F.col("len")).alias("src_len"), "via_len", F.when(passes, F.col("level")).alias("src_level"), "via_level",
        F.lit(False).alias("out"),
    )
    return resting.select(moved.columns).unionAll(moved)


def _doubled(chain: DataFrame, begins: DataFrame, bound: int, farthest: int) -> DataFrame:
    """(start, round, src, level): the links that walks pass, the distance doubled per step, one table each."""
    parts = int(chain.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    reached = begins.select("start", F.col("round").cast("bigint").alias("round"), "src")
    jumps = chain.where(F.col("dst").isNotNull()).select("src", "dst", "len")
    span = 1
    while span <= farthest:
        hops = (
            reached.join(jumps, "src")
            .select("start", (F.col("round") - F.col("len")).alias("round"), F.col("dst").alias("src"))
            .where(F.col("round") >= bound)
        )
        step = hops.select(F.lit(True).alias("hop"), "start", "round", "src", F.lit(None).cast(jumps.schema["src"].dataType).alias("dst"))
        if 2 * span <= farthest:
            far = jumps.select(F.col("src").alias("mid"), F.col("dst").alias("far"), F.col("len").alias("more"))
            longer = jumps.join(far, F.col("dst") == F.col("mid")).where(F.col("len") + F.col("more") <= farthest)
            start = F.lit(None).cast(begins.schema["start"].dataType)
            step = step.unionAll(longer.select(F.lit(False), start, F.col("len") + F.col("more"), "src", "far"))
        seen = Observation()
        # A broadcast join keeps the parts of its inputs, whose number would double with the distance.
        step = step.coalesce(parts).observe(seen, F.count(F.when(F.col("hop"), 1)).alias("hops"))
        step = written(step, "hops")
        if not seen.get["hops"]:
            break
        reached = reached.unionAll(step.where("hop").select("start", "round", "src"))
        jumps = step.where(~F.col("hop")).select("src", "dst", F.col("round").alias("len"))
        span *= 2
    return written(reached.join(chain.select("src", "level"), "src").select("start", "round", "src", "level"), "walks")


def _draw(key: Column, seed: str) -> Column:
    return F.md5(F.concat(key.cast("string"), F.lit(seed)))


def audit_sample(df: DataFrame, seed: str, k: int = AUDIT_SAMPLE, group: str = "round", key: str = "key") -> DataFrame:
    """Up to `k` distinct submissions per round in a repeatable random order."""
    distinct = df.select(group, key).distinct()
    return first_per_group(distinct, [group], [_draw(F.col(key), seed).asc(), F.asc(key)], k)


def proof_draws(
    df: DataFrame, seed: str, draws: int = PROOF_DRAWS, group: str = "round", key: str = "key"
) -> DataFrame:
    """`draws` independent picks per group, with replacement; each is a minimum, so groups are never gathered."""
    picks = [F.min(F.struct(_draw(F.col(key), f"{seed}{n}").alias("h"), F.col(key).alias("k"))).alias(f"p{n}")
             for n in range(draws)]
    numbered = [F.struct(F.lit(n).alias("draw"), F.col(f"p{n}.k").alias(key)) for n in range(draws)]
    return df.groupBy(group).agg(*picks).select(group, F.inline(F.array(*numbered)))
