"""Measures of extraction runs: hits, noise, precision, response times, bottlenecks and means over cases."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpuskb.functions.text import norm_text

#: Phrases of facts that say nothing.
GENERIC_NOISE = (r"персонаж,?\s*котор", "место действия", r"это место,?\s*где", "это персонаж", "упоминается в контексте", "видимо", "возможно", "вероятно", "главный герой")
#: The decoding speed that counts as whole efficiency, and chunks and books of a corpus.
DECODE_CEILING, CHUNKS_PER_BOOK, BOOKS = 55.0, 120, 32


def hits(facts: DataFrame, expected: DataFrame) -> DataFrame:
    """(case_id, n, hit) of expectations (case_id, n, subject, contains): whether a fact of the case has both, whatever their case."""
    low = lambda c: F.lower(F.coalesce(c, F.lit("")))
    f = facts.select("case_id", low(F.col("subject")).alias("s"), low(F.col("fact")).alias("t"))
    e = expected.select("case_id", "n", low(F.col("subject")).alias("subject"), low(F.col("contains")).alias("contains"))
    met = F.contains(F.col("s"), F.col("subject")) & F.contains(F.col("t"), F.col("contains"))
    return e.join(f, "case_id", "left").groupBy("case_id", "n").agg(F.coalesce(F.bool_or(met), F.lit(False)).alias("hit"))


def signal_hits(facts: DataFrame, signals: DataFrame) -> DataFrame:
    """(case_id, n, hit) of signals (case_id, n, subject_tokens, fact_tokens): whether one fact has all of them in its normalized parts."""
    f = facts.select("case_id", norm_text(F.col("subject")).alias("s"), norm_text(F.col("fact")).alias("t"))
    every = lambda tokens, text: F.forall(tokens, lambda t: F.contains(F.col(text), t))
    met = (F.col("s") != "") & (F.col("t") != "") & every("subject_tokens", "s") & every("fact_tokens", "t")
    return signals.join(f, "case_id", "left").groupBy("case_id", "n").agg(F.coalesce(F.bool_or(met), F.lit(False)).alias("hit"))


def precision(facts: DataFrame, absent: list[str]) -> DataFrame:
    """(case_id, n_facts, n_noise, precision): one less the share of noise, which is unwanted markers found and generic facts."""
    full = F.lower(F.concat_ws(" ", F.coalesce("subject", F.lit("")), F.coalesce("fact", F.lit(""))))
    generic = F.lit(False)
    for pattern in GENERIC_NOISE:
        generic = generic | full.rlike("(?U)" + pattern)
    found = [F.max(F.contains(full, F.lit(m.lower())).cast("int")) for m in absent]
    noise = F.count_if(generic)
    for one in found:
        noise = noise + one
    out = facts.groupBy("case_id").agg(F.count("*").alias("n_facts"), noise.cast("long").alias("n_noise"))
    return out.withColumn("precision", F.greatest(F.lit(0.0), 1 - F.col("n_noise") / F.col("n_facts")))


def response_metrics(total: Column, load: Column, prompt_n: Column, prompt_ns: Column, eval_n: Column, eval_ns: Column) -> Column:
    """Rates, overhead and efficiency of one response from its counts and nanoseconds."""
    rate = lambda n, ns: F.when(ns > 0, n / (ns / 1e9)).otherwise(0.0)
    speed = rate(eval_n, eval_ns)
    return F.struct(
        rate(prompt_n, prompt_ns).alias("prompt_eval_rate"),
        speed.alias("eval_rate"),
        F.greatest(F.lit(0.0), (total - prompt_ns - eval_ns - load) / 1e6).alias("overhead_ms"),
        (prompt_n + eval_n).alias("total_tokens"),
        F.when(total > 0, total / 1e9).otherwise(0.0).alias("effective_time_sec"),
        (speed / DECODE_CEILING).alias("decode_efficiency"),
    )


def bottleneck(offload: Column, gpu: Column, temperature: Column, power: Column, power_limit: Column, memory: Column, vram_free: Column) -> Column:
    """The first limit that a run shows; a measure that is missing shows none."""
    return (
        F.when(F.coalesce(offload, F.lit(1.0)) < 1, "CPU_OFFLOAD")
        .when(gpu < 50, "GPU_UNDERUTILIZED")
        .when(temperature > 87, "THERMAL_THROTTLING")
        .when((power > 0) & (power_limit > 0) & (power >= power_limit * 0.95), "TDP_THROTTLING")
        .when(memory > 90, "MEMORY_BANDWIDTH")
        .when(vram_free < 200, "VRAM_NEAR_OOM")
        .otherwise("COMPUTE_BOUND")
    )


def aggregates(cases: DataFrame) -> DataFrame:
    """Means over the cases (model, hit_rate, precision, time_sec, parse_errors) of each model, with hours for a corpus and scores."""
    out = cases.groupBy("model").agg(F.avg("hit_rate").alias("hit_rate"), F.avg("precision").alias("precision"), F.avg("time_sec").alias("time_sec"), (F.count_if(F.col("parse_errors") == 0) / F.count("*")).alias("reliability"))
    hours = F.col("time_sec") * CHUNKS_PER_BOOK * BOOKS / 3600
    speed = F.when(F.col("time_sec") > 0, F.col("hit_rate") * F.col("precision") / F.col("time_sec")).otherwise(0.0)
    return out.withColumns({"hours": hours, "hours_ensemble": hours * 1.3, "quality_speed": speed, "quality": F.col("hit_rate") * F.col("precision") * F.col("reliability")})


def parse_errors(response: Column) -> Column:
    """How many lines look like facts but lack a category or a fact, or are no facts at all; headings, lists and objects aside."""
    lines = F.transform(F.split(F.coalesce(response, F.lit("")), r"\r\n|[\n\r]"), lambda x: F.trim(F.regexp_replace(F.regexp_replace(x, r"(?U)^\s*[-*•]\s*|^\s+|\s+$", ""), r"(?U)^\s*[0-9]+[.)]\s*", "")))
    named = lambda x, key: x.rlike(rf"(?iU)(?:^|\|)\s*{key}\s*=\s*[^|\s]")
    skipped = lambda x: (x == "") | x.startswith("#") | (x.startswith("[") & x.endswith("]"))
    wrong = lambda x: ~skipped(x) & F.when(F.contains(x, F.lit("|")), ~(named(x, "category") & named(x, "fact"))).otherwise(~x.startswith("{"))
    return F.size(F.filter(lines, wrong)).cast("long")


def best_models(results: DataFrame) -> DataFrame:
    """(pick, model): the fastest, the best, and the pair of them, of results (ord, model, n_cases, hit_rate, offload, quality_speed, quality).

    Only models with cases and hits count. The fastest is one without offload if there is such a one; where it is also the
    best, the second best stands beside it. Of equals the first by ``ord`` is taken.
    """
    valid = results.where("n_cases > 0 and hit_rate > 0")
    top = lambda score: F.max_by("model", F.struct(F.col(score), -F.col("ord")))
    gpu = F.max_by(F.when(F.coalesce("offload", F.lit(1.0)) >= 0.99, F.col("model")), F.when(F.coalesce("offload", F.lit(1.0)) >= 0.99, F.struct(F.col("quality_speed"), -F.col("ord"))))
    # one row of two names
    firsts = valid.agg(F.coalesce(gpu, top("quality_speed")).alias("fast"), top("quality").alias("best"))
    other = F.when(F.col("model") != F.col("best"), F.struct(F.col("quality"), -F.col("ord")))
    out = valid.crossJoin(F.broadcast(firsts)).agg(F.first("fast").alias("fast"), F.first("best").alias("best"), F.max_by("model", other).alias("next"))
    second = F.when(F.col("fast") != F.col("best"), F.col("best")).otherwise(F.when(F.col("next") != F.col("best"), F.col("next")))
    named = lambda pick, model: F.struct(F.lit(pick).alias("pick"), model.alias("model"))
    return out.select(F.inline(F.array(named("speed", F.col("fast")), named("quality", F.col("best")), named("second", second)))).where("model is not null")


def run_stats(traces: DataFrame) -> DataFrame:
    """(run_id, n, latest_at) of traces (run_id, at)."""
    return traces.groupBy("run_id").agg(F.count("*").alias("n"), F.max("at").alias("latest_at"))
