"""Gate, validation, tiers, work selection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Thresholds of the gate.
STRUCTURE, FIDELITY, RATE, COVERED = 85, 90, 0.95, 0.9
# Words that make a name generic (validation), its suffixes; words and roots for merging.
GENERIC_WORDS = "众人 众 们 人群 群众 队伍 百姓 村民 百官 路人 旁人 他人 某人 有人 来人 那人 此人 凡人 老人 老者 男人 女人 男子 女子 青年 少年 少女 姑娘 孩子 孩童 小孩 妇人 夫人 中年 乞丐 护卫 护院 家丁 小厮 丫鬟 婢女 侍女 侍从 下人 杂役 车夫 船夫 掌柜 伙计 商贩 兵士 士兵 官兵 武将 将领 甲士 兵卒 守军 铁骑 御林军 玄甲军 宫人 官员 弟子 修士 长老 宿老 仙师 和尚 道姑 道人 儒生 峰主 楼主 宗主 掌门 活尸 纸人 妖 魔修 魔 虚影 声音 喊声 黑狗 土狗 唱名者 说话者 念信的人 叙述者 旁白".split()
GENERIC_SUFFIXES = "甲 乙 丙 丁 戊 己 庚 辛 等人 等 军 队 众 群".split()


def problems(**conditions: Column) -> Column:
    """Names of the conditions that hold, in the order given; names may have spaces as underscores."""
    return F.filter(F.array(*[F.when(c, F.lit(n.replace("_", " "))) for n, c in conditions.items()]), lambda x: x.isNotNull())


def gate(df: DataFrame, structure: str = "structure_score", fidelity: str = "fidelity_score", rate: str = "verbatim_rate", miss: str = "miss") -> DataFrame:
    """Add fail_reasons and passed; a null score counts as 0."""
    zero = lambda c: F.coalesce(F.col(c), F.lit(0))
    reasons = problems(structure=zero(structure) < STRUCTURE, fidelity=zero(fidelity) < FIDELITY, verbatim=F.col(rate) < RATE, fabricated=F.col(miss) > 0)
    return df.withColumn("fail_reasons", reasons).withColumn("passed", F.size("fail_reasons") == 0)


def tiers(df: DataFrame, structure: str = "structure_score", fidelity: str = "fidelity_score", rate: str = "verbatim_rate", miss: str = "miss") -> DataFrame:
    """Add tier: T1 fabricated, T2 rate or a score below the bar (a null or 0 score passes), T3 the rest."""
    low = lambda c, bar: (F.coalesce(F.col(c), F.lit(0)) != 0) & (F.col(c) < bar)
    return df.withColumn("tier", F.when(F.col(miss) > 0, "T1").when((F.col(rate) < RATE) | low(structure, STRUCTURE) | low(fidelity, FIDELITY), "T2").otherwise("T3"))


def validation(df: DataFrame, ends: str = "。！？…”\"）)】》」』~～") -> DataFrame:
    """Add problems of analysed units: columns synopsis, miss, near, verbatim_rate, coverage_rate, structure_score, fidelity_score, review_length, calls, is_manual, duplicate_names, unregistered, ghost_speakers, stages."""
    last = F.substring(F.col("synopsis"), -1, 1)
    return df.withColumn("problems", problems(
        synopsis_missing=F.col("synopsis").isNull(), synopsis_short=F.length("synopsis") < 40, synopsis_truncated=(F.length("synopsis") > 0) & ~F.contains(F.lit(ends), last),
        fabricated=F.col("miss") > 0, reworded=F.col("near") > 0, verbatim_low=F.col("verbatim_rate") < RATE, coverage_low=F.col("coverage_rate") < COVERED,
        duplicate_names=F.col("duplicate_names") > 0, unregistered_attendees=F.col("unregistered") > 0, ghost_speakers=F.col("ghost_speakers") > 0,
        review_missing=F.col("stages") < 2, score_missing=F.col("structure_score").isNull() | F.col("fidelity_score").isNull(), review_short=F.col("review_length") < 100, calls_few=~F.col("is_manual") & (F.col("calls") < 3),
    ))


def problem_histogram(df: DataFrame, problem: str, most: int = 12) -> DataFrame:
    """kind, n: text before a bracket or colon, its first 14 characters; the most frequent."""
    kind = F.substring(F.regexp_extract(problem, "^[^（(：:]*", 0), 1, 14)
    return df.groupBy(kind.alias("kind")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "kind").limit(most)


def score_distribution(df: DataFrame, score: str, bar: float) -> DataFrame:
    return df.agg(F.count(score).alias("n"), F.round(F.avg(score), 6).alias("mean"), F.percentile(score, 0.5).alias("median"), F.min(score).alias("least"), F.count_if(F.col(score) < bar).alias("below"))


def generic_name(name: Column, words: list[str] = GENERIC_WORDS, suffixes: list[str] = GENERIC_SUFFIXES) -> Column:
    """Empty, holding one of the words, or ending with one of the suffixes."""
    n = F.trim(F.coalesce(name, F.lit("")))
    out = n == ""
    if words:
        out |= n.rlike("|".join(words))
    if suffixes:
        out |= n.rlike("(" + "|".join(suffixes) + ")$")
    return out


def unregistered(names: DataFrame, known: DataFrame, words: list[str] = GENERIC_WORDS, suffixes: list[str] = GENERIC_SUFFIXES) -> DataFrame:
    """Rows of names (seq, name) not among known (seq, name), neither generic nor known without a bracketed note."""
    rows = names.where(~generic_name(F.col("name"), words, suffixes)).withColumn("_bare", F.trim(F.split("name", "[（(]")[0]))
    known = known.select("seq", F.col("name").alias("_known")).distinct()
    rows = rows.join(known, (rows["seq"] == known["seq"]) & (F.col("name") == F.col("_known")), "left_anti")
    return rows.join(known, (rows["seq"] == known["seq"]) & (F.col("_bare") == F.col("_known")), "left_anti").drop("_bare")


def work_state(expected: DataFrame, done: DataFrame) -> DataFrame:
    """seq, state of expected units: missing, incomplete (no finished_at), failed, done. done: seq, finished_at, passed."""
    state = F.when(F.col("_there").isNull(), "missing").when(F.col("finished_at").isNull(), "incomplete").when(~F.coalesce("passed", F.lit(False)), "failed").otherwise("done")
    return expected.select("seq").join(done.withColumn("_there", F.lit(1)), "seq", "left").select("seq", state.alias("state"))


def todo(states: DataFrame, force: bool = False, redo_failed: bool = False, review: bool = False) -> DataFrame:
    """Units to work on: all by force; missing and incomplete; failed on request; in review those that are finished but failed."""
    if force:
        return states.select("seq")
    wanted = ["failed"] if review else ["missing", "incomplete", *(["failed"] if redo_failed else [])]
    return states.where(F.col("state").isin(wanted)).select("seq")


def rerun_set(states: DataFrame, problem_units: DataFrame) -> DataFrame:
    """Missing units and those with problems, each once."""
    return states.where("state = 'missing'").select("seq").union(problem_units.select("seq")).distinct()


def reviews(docs: DataFrame) -> DataFrame:
    """One row a review of analysed documents."""
    return docs.select("seq", F.posexplode("reviews").alias("pos", "r")).select("seq", "pos", "r.*")


def repaired_units(df: DataFrame, rounds: str = "repair_rounds") -> DataFrame:
    """units, repaired: those that took a repair round or more."""
    return df.agg(F.count("*").alias("units"), F.count_if(F.col(rounds) > 0).alias("repaired"))


def token_usage(calls: DataFrame, *keys: str) -> DataFrame:
    """Prompt and completion tokens of a call log."""
    return calls.groupBy(*keys).agg(F.sum("prompt_tokens").alias("prompt_tokens"), F.sum("completion_tokens").alias("completion_tokens"))


def usage(calls: DataFrame, *keys: str) -> DataFrame:
    """Calls, retries, failures and totals of a call log."""
    return calls.groupBy(*keys).agg(F.count("*").alias("calls"), F.count_if(F.col("attempt") > 1).alias("retries"), F.count_if(F.col("error").isNotNull()).alias("failures"), F.round(F.sum("elapsed"), 2).alias("elapsed"), F.sum("chars").alias("chars"))


def latest_reviews(rows: DataFrame) -> DataFrame:
    """The last round of each unit and stage."""
    w = Window.partitionBy("seq", "stage").orderBy(F.desc("round"), F.desc("pos"))
    return rows.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")
