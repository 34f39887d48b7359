"""One query per operator over the driver's tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newscorpus.functions import rouge as rg
from newscorpus.functions import sql as sqlf
from newscorpus.functions import text as tx
from newscorpus.operators import curate, evaluate, prep, runs, stats, summarize
from newscorpus.operators.extract import extract_body
from newscorpus.operators.rules import Rule, Selector
from newscorpus.plans import bindings as b
from newscorpus.plans import daily
from newscorpus.schemas import ARTICLE, PREDICTION
from newscorpus.sources import articles as io
from newscorpus.sources import rejects, scratch
from newscorpus.sources import scalars as scalar_io
from newscorpus.streaming import incremental

Query = Callable[[SparkSession, str], DataFrame]

VOCAB_SIZE = 8000
#: Words looked up in the row where a query shows the join of the others.
JOINED_MAP_WORDS = 100
MAX_INPUT, MAX_TARGET = 512, 128
SAMPLE_SIZES = {"50": 50, "150": 150, "2k": 2_000, "10k": 10_000, "50k": 50_000}
HEAD_SIZE = SAMPLE_SIZES["2k"]
DAY = "2024-01-02"
DAYS = ["2024-01-02", "2024-01-03", "2024-01-04"]


def _text(ids: str) -> Column:
    """An id array as text, so results compare as plain values."""
    return F.array_join(F.transform(F.col(ids), lambda i: i.cast("string")), " ")


def _long(*names: str) -> dict[str, Column]:
    return {n: F.col(n).cast("bigint") for n in names}


def _single(df: DataFrame, *names: str) -> DataFrame:
    """Single precision, on which engines agree where the last bits differ."""
    return df.withColumns({n: F.col(n).cast("float").cast("double") for n in names})


# --- ingest and curation ---------------------------------------------------


def pending_queries(spark: SparkSession, sf: str) -> DataFrame:
    phrase = F.concat(F.lit(" "), F.col("lang"), F.lit(" "), F.col("source"))
    docs = b.table(spark, sf, "documents").select(phrase.alias("value"))
    return curate.pending_queries(docs, docs.where(F.col("value").rlike("[02468]$")))


def page_plan(spark: SparkSession, sf: str) -> DataFrame:
    totals = b.articles(spark, sf).groupBy("category").agg(F.count("*").alias("total"))
    return curate.page_plan(totals)


def flatten_articles(spark: SparkSession, sf: str) -> DataFrame:
    return curate.flatten_articles(b.responses(spark, sf))


def append_read_articles(spark: SparkSession, sf: str) -> DataFrame:
    """Two appends, then the whole table back."""
    path = scratch.new_path(spark, "news_articles")
    rows = b.articles(spark, sf).drop("page_key", "published_date")
    even = F.col("article_id") % 2 == 0
    io.append_articles(rows.where(even), path)
    io.append_articles(rows.where(~even), path, rebalance=False)
    return io.read_articles(spark, path).withColumn(
        "published_date", F.col("published_date").cast("string")
    )


def csv_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch.new_path(spark, "article_csv")
    io.export_csv(b.articles(spark, sf).select(*ARTICLE.fieldNames()), path)
    return io.read_csv_corpus(spark, path, ARTICLE)


def day_slice(spark: SparkSession, sf: str) -> DataFrame:
    return curate.day_slice(b.articles(spark, sf), DAY).select(
        "article_id", "url", "published_at", "content"
    )


def drop_missing(spark: SparkSession, sf: str) -> DataFrame:
    return curate.drop_missing(b.articles(spark, sf), ["author", "url", "title"]).select(
        "article_id", "author", "url", "title"
    )


def dedupe_keep_first(spark: SparkSession, sf: str) -> DataFrame:
    return curate.dedupe_keep_first(
        b.articles(spark, sf), ["published_date", "url"], ["article_id"]
    ).select("article_id", "url")


def dedupe_by_text(spark: SparkSession, sf: str) -> DataFrame:
    docs = b.documents(spark, sf).select(
        "doc_id", "lang", "source", curate.digest("text").alias("key")
    )
    return curate.dedupe_keep_first(docs, ["key"], ["doc_id"]).drop("key")


def detect_language(spark: SparkSession, sf: str) -> DataFrame:
    docs = b.documents(spark, sf)
    return curate.detect_language(docs, "text").select("doc_id", "detected")


def filter_language(spark: SparkSession, sf: str) -> DataFrame:
    return curate.filter_language(b.articles(spark, sf)).select("article_id", "content")


def language_report(spark: SparkSession, sf: str) -> DataFrame:
    return curate.language_report(b.documents(spark, sf), "text", "lang")


def extract_body_flat(spark: SparkSession, sf: str) -> DataFrame:
    return b.page_text(spark, sf)


def extract_body_nested(spark: SparkSession, sf: str) -> DataFrame:
    """The same pages through the tag-stack reader."""
    rule = Rule("page", path=(Selector("article"),))
    named = b.pages(spark, sf).withColumn("source_name", F.lit("page"))
    return extract_body(named, [rule]).select("page_id", "full_content")


def extract_body_sites(spark: SparkSession, sf: str) -> DataFrame:
    """Every rule of the site table, its JSON kinds and its fallback, in one plan."""
    return extract_body(b.site_pages(spark, sf)).select("page_id", "source_name", "full_content")


def extract_body_rules(spark: SparkSession, sf: str) -> DataFrame:
    """Whole-page, last-paragraph, marker and heading variants, by page number."""
    article = (Selector("article"),)
    rules = [
        Rule("site0", path=article, drop_last=1),
        Rule("site1", path=article, cut_at=" the "),
        Rule("site2", path=(Selector("body"), Selector("article"))),
        Rule("site3", path=article, children=("h1",)),
        Rule("site4", path=(Selector("div", "class", "absent"),)),
        b.flat_article_rule("site5"),
    ]
    site = F.concat(F.lit("site"), (F.col("page_id") % 7).cast("string"))
    named = b.pages(spark, sf).withColumn("source_name", site)
    return extract_body(named, rules).select("page_id", "source_name", "full_content")


def _curated(spark: SparkSession, sf: str) -> DataFrame:
    return daily.curate_articles(
        b.articles(spark, sf),
        rules=b.SOURCE_RULES,
        pages=b.article_pages(spark, sf),
        page_key="page_key",
    )


def _curated_columns(df: DataFrame) -> DataFrame:
    return df.select(
        "article_id",
        F.col("published_date").cast("string").alias("published_date"),
        "source_name",
        "author",
        "title",
        "url",
        "content",
        "full_content",
    )


def daily_curation(spark: SparkSession, sf: str) -> DataFrame:
    return _curated_columns(_curated(spark, sf))


def incremental_curation(spark: SparkSession, sf: str) -> DataFrame:
    """The same chain as a stream of landed files, in two parts with a checkpoint each.

    The second stream is new: it sees the files of the first again.
    """
    root = scratch.new_path(spark, "incremental")
    rows = b.articles(spark, sf)
    # copies are neighbours by id: a first part whole, then the others
    early = F.floor(F.col("article_id") / 2) % 3 < 2
    for part, checkpoint in ((early, "first"), (~early, "second")):
        rows.where(part).repartition(4, "article_id").write.mode("append").parquet(f"{root}/landed")
        incremental.incremental_curation(
            spark,
            source=f"{root}/landed",
            schema=rows.schema,
            target=f"{root}/curated",
            ledger=f"{root}/ledger",
            checkpoint=f"{root}/{checkpoint}",
            rules=b.SOURCE_RULES,
            join_pages=lambda df: df.join(b.article_pages(df.sparkSession, sf), "page_key"),
        )
    return _curated_columns(incremental.read_curated(spark, f"{root}/curated", f"{root}/ledger"))


def _landed_days(spark: SparkSession, sf: str) -> tuple[str, str]:
    """An article table flattened from responses, and a place for its curated days."""
    source = scratch.new_path(spark, "news_articles")
    io.append_articles(curate.flatten_articles(b.responses(spark, sf), with_ids=True), source)
    return source, scratch.new_path(spark, "curated")


def _run_days(spark: SparkSession, sf: str, source: str, target: str, days: list[str]) -> None:
    pages = b.url_pages(spark, sf)
    for day in days:
        daily.run_day(
            spark, source, target, day, rules=b.SOURCE_RULES, pages=pages, page_key="url",
            order=("position", "article_id"),
        )


def run_day_round_trip(spark: SparkSession, sf: str) -> DataFrame:
    """Responses, article table, and the curated days of it that were run."""
    source, target = _landed_days(spark, sf)
    _run_days(spark, sf, source, target, DAYS[:2])
    return _curated_columns(io.read_articles(spark, target))


def rerun_day(spark: SparkSession, sf: str) -> DataFrame:
    """Days that are run again after the first lost all its articles and the second some."""
    source, target = _landed_days(spark, sf)
    _run_days(spark, sf, source, target, DAYS)
    rows = curate.flatten_articles(b.responses(spark, sf), with_ids=True)
    rows = io.with_published_date(rows)
    io.replace_day(rows.limit(0), source, DAYS[0])
    io.replace_day(rows.where(F.col("position") % 2 == 0), source, DAYS[1])
    _run_days(spark, sf, source, target, DAYS[:2])
    return _curated_columns(io.read_articles(spark, target))


def reject_report(spark: SparkSession, sf: str) -> DataFrame:
    """Broken responses and CSV lines, counted after a write that kept them."""
    root = scratch.new_path(spark, "landed")
    b.response_lines(spark, sf).write.json(f"{root}/json")
    rejects.write_checked(rejects.checked_articles(io.read_responses(spark, f"{root}/json")), f"{root}/articles")
    b.csv_lines(spark, sf).write.text(f"{root}/csv")
    schema = T.StructType.fromDDL("doc_id bigint, lang string, n_chars bigint, text string")
    checked = io.read_csv_corpus(spark, f"{root}/csv", schema, checked=True, header=False)
    rejects.write_checked(checked, f"{root}/documents")

    def of(table: str) -> DataFrame:
        return rejects.reject_report(spark, f"{root}/{table}").withColumn("landed", F.lit(table))

    return of("articles").unionByName(of("documents"))


def curated_length_report(spark: SparkSession, sf: str) -> DataFrame:
    return daily.flagship(
        b.articles(spark, sf),
        rules=b.SOURCE_RULES,
        pages=b.article_pages(spark, sf),
        page_key="page_key",
    )


# --- training-set preparation ----------------------------------------------


def head_sample(spark: SparkSession, sf: str) -> DataFrame:
    return prep.head_sample(b.summaries(spark, sf), HEAD_SIZE, ["article_id"]).select(
        "article_id", "highlights"
    )


def nested_samples(spark: SparkSession, sf: str) -> DataFrame:
    ids = b.summaries(spark, sf).select("article_id")
    return prep.nested_samples(ids, SAMPLE_SIZES, ["article_id"])


def split_train_val(spark: SparkSession, sf: str) -> DataFrame:
    return prep.split_train_val(b.summaries(spark, sf), "article_id").select("article_id", "split")


def split_by_modulus(spark: SparkSession, sf: str) -> DataFrame:
    return prep.split_by_modulus(b.summaries(spark, sf), "article_id").select("article_id", "split")


def select_pair_columns(spark: SparkSession, sf: str) -> DataFrame:
    aliased = b.summaries(spark, sf).withColumnsRenamed(
        {"article": "clean_text", "highlights": "Summary"}
    )
    return prep.select_pair_columns(aliased, keep=["article_id"])


def add_task_prefix(spark: SparkSession, sf: str) -> DataFrame:
    docs = b.summaries(spark, sf).select(
        "article_id",
        F.when(F.col("article_id") % 2 == 0, "T5 Base").otherwise("Pegasus CNN").alias("family"),
        "article",
    )
    return prep.add_task_prefix(docs, F.col("family"))


def _vocab(spark: SparkSession, sf: str) -> DataFrame:
    return prep.build_vocab(b.summaries(spark, sf), ["article", "highlights"], VOCAB_SIZE)


def build_vocab(spark: SparkSession, sf: str) -> DataFrame:
    return _vocab(spark, sf).withColumns(_long("id"))


def _stored_vocab(spark: SparkSession, sf: str) -> DataFrame:
    return scratch.saved(_vocab(spark, sf), "vocab")


def _encoded(spark: SparkSession, sf: str, vocab: DataFrame | None = None, **options) -> DataFrame:
    vocab = _stored_vocab(spark, sf) if vocab is None else vocab
    encoded = prep.encode_pairs(b.summaries(spark, sf), vocab, MAX_INPUT, MAX_TARGET, **options)
    return encoded.select("article_id", "input_ids", "attention_mask", "labels")


def _ids_as_text(df: DataFrame, *cols: str) -> DataFrame:
    return df.select("article_id", *[_text(c).alias(c) for c in cols])


def encode_pairs(spark: SparkSession, sf: str) -> DataFrame:
    return _ids_as_text(_encoded(spark, sf), "input_ids", "attention_mask", "labels")


def encode_pairs_joined(spark: SparkSession, sf: str) -> DataFrame:
    """The same ids with most of the vocabulary beyond what a row looks up itself."""
    encoded = _encoded(spark, sf, map_words=JOINED_MAP_WORDS)
    return _ids_as_text(encoded, "input_ids", "attention_mask", "labels")


def pad_fixed(spark: SparkSession, sf: str) -> DataFrame:
    padded = prep.pad_fixed(
        _encoded(spark, sf),
        {"input_ids": MAX_INPUT, "attention_mask": MAX_INPUT, "labels": MAX_TARGET},
    )
    return _ids_as_text(padded, "input_ids", "attention_mask", "labels")


def pad_longest(spark: SparkSession, sf: str) -> DataFrame:
    return _ids_as_text(
        prep.pad_longest(_encoded(spark, sf), ["input_ids", "labels"]), "input_ids", "labels"
    )


def _decoded(spark: SparkSession, sf: str, **options) -> DataFrame:
    vocab = _stored_vocab(spark, sf)
    padded = prep.pad_fixed(_encoded(spark, sf, vocab, **options), {"labels": MAX_TARGET})
    ignored = padded.withColumn(
        "labels",
        F.transform("labels", lambda i: F.when(i == prep.PAD, prep.IGNORED_LABEL).otherwise(i)),
    )
    return prep.decode_ids(ignored, vocab, "labels", **options).select("article_id", "decoded")


def decode_ids(spark: SparkSession, sf: str) -> DataFrame:
    """Labels with padding replaced by the ignored id, decoded again."""
    return _decoded(spark, sf)


def decode_ids_joined(spark: SparkSession, sf: str) -> DataFrame:
    """The same texts with most of the vocabulary beyond what a row looks up itself."""
    return _decoded(spark, sf, map_words=JOINED_MAP_WORDS)


def chunk_text(spark: SparkSession, sf: str) -> DataFrame:
    docs = b.documents(spark, sf).select("doc_id", "text")
    return prep.chunk_text(docs, "text").withColumns(_long("chunk_no"))


# --- corpus statistics -----------------------------------------------------


def text_lengths(spark: SparkSession, sf: str) -> DataFrame:
    return stats.text_lengths(b.documents(spark, sf), "text").select(
        "doc_id", "char_len", "word_len"
    )


def length_report(spark: SparkSession, sf: str) -> DataFrame:
    return stats.length_report(b.summaries(spark, sf), ["article", "highlights"])


def avg_length(spark: SparkSession, sf: str) -> DataFrame:
    df = stats.avg_length(b.summaries(spark, sf), ["article", "highlights"])
    return _single(df, "avg_words")


def length_histogram(spark: SparkSession, sf: str) -> DataFrame:
    return stats.length_histogram(b.documents(spark, sf), "text")


def top_words(spark: SparkSession, sf: str) -> DataFrame:
    return stats.top_words(b.documents(spark, sf), "text")


def top_bigrams(spark: SparkSession, sf: str) -> DataFrame:
    return stats.top_bigrams(b.documents(spark, sf), "text")


def term_weights(spark: SparkSession, sf: str) -> DataFrame:
    return _single(stats.term_weights(b.documents(spark, sf), "text"), "weight")


def category_counts(spark: SparkSession, sf: str) -> DataFrame:
    return stats.category_counts(b.documents(spark, sf), "source")


def event_type_counts(spark: SparkSession, sf: str) -> DataFrame:
    return stats.event_type_counts(b.documents(spark, sf), "text", b.EVENT_TRIGGERS)


def extract_entities(spark: SparkSession, sf: str) -> DataFrame:
    return stats.extract_entities(b.documents(spark, sf), "text")


# --- summary evaluation ----------------------------------------------------


def rouge_tokens(spark: SparkSession, sf: str) -> DataFrame:
    return b.documents(spark, sf).select(
        "doc_id", F.array_join(rg.rouge_tokens(F.col("text")), " ").alias("tokens")
    )


def rouge_tokens_stemmed(spark: SparkSession, sf: str) -> DataFrame:
    return b.documents(spark, sf).select(
        "doc_id", F.array_join(rg.rouge_tokens(F.col("text"), stemmed=True), " ").alias("tokens")
    )


def _scores(df: DataFrame, *metrics: str, stemmed: bool = False) -> DataFrame:
    return evaluate.score_pairs(df, metrics, stemmed=stemmed)


def _f1s(df: DataFrame, metric: str) -> DataFrame:
    parts = ("precision", "recall", "f1")
    return _single(df.select("pair_id", *[F.col(metric)[p].alias(p) for p in parts]), *parts)


def rouge_1(spark: SparkSession, sf: str) -> DataFrame:
    return _f1s(_scores(b.pairs(spark, sf), "rouge1"), "rouge1")


def rouge_2(spark: SparkSession, sf: str) -> DataFrame:
    return _f1s(_scores(b.pairs(spark, sf), "rouge2"), "rouge2")


def rouge_l(spark: SparkSession, sf: str) -> DataFrame:
    return _f1s(_scores(b.pairs(spark, sf), "rougeL"), "rougeL")


def rouge_lsum(spark: SparkSession, sf: str) -> DataFrame:
    return _f1s(_scores(b.pairs(spark, sf), "rougeLsum"), "rougeLsum")


def rouge_corpus(spark: SparkSession, sf: str) -> DataFrame:
    scored = _scores(b.pairs(spark, sf), "rouge1", "rouge2")
    return evaluate.rouge_corpus(scored, ["rouge1", "rouge2"])


def rouge_corpus_by_turn(spark: SparkSession, sf: str) -> DataFrame:
    scored = _scores(b.pairs(spark, sf), "rouge1", "rouge2")
    return evaluate.rouge_corpus(scored, ["rouge1", "rouge2"], by=["turn"])


def rouge_corpus_lcs(spark: SparkSession, sf: str) -> DataFrame:
    scored = _scores(b.pairs(spark, sf), "rougeL", "rougeLsum")
    return evaluate.rouge_corpus(scored, ["rougeL", "rougeLsum"])


def rouge_corpus_stemmed(spark: SparkSession, sf: str) -> DataFrame:
    """All four metrics with stemming, as training evaluation reports them."""
    scored = _scores(b.pairs(spark, sf), *evaluate.METRICS, stemmed=True)
    return evaluate.rouge_corpus(scored, evaluate.METRICS)


def rouge_bootstrap(spark: SparkSession, sf: str) -> DataFrame:
    scored = _scores(b.pairs(spark, sf), "rouge1", "rouge2")
    out = evaluate.rouge_bootstrap(scored, "pair_id", ["rouge1", "rouge2"], reps=200)
    return _single(out, "low", "mid", "high")


def gen_len(spark: SparkSession, sf: str) -> DataFrame:
    padded = prep.pad_fixed(_encoded(spark, sf), {"labels": MAX_TARGET})
    return _single(evaluate.gen_len(padded, "labels"), "gen_len")


def write_eval_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """Scores per turn as evaluation scalars, written and read back."""
    path = scratch.new_path(spark, "rouge_results")
    wide = rouge_corpus_by_turn(spark, sf)
    scalar_io.write_eval_metrics(
        evaluate.metrics_to_scalars(wide, ["rouge1", "rouge2"], F.lit("run0"), F.col("turn")), path
    )
    return scalar_io.read_eval_metrics(spark, path)


# --- batch summarization ---------------------------------------------------


def summarize_corpus(spark: SparkSession, sf: str) -> DataFrame:
    return summarize.summarize_corpus(
        b.summaries(spark, sf), lambda: summarize.LeadScorer(128), max_input_words=MAX_INPUT
    )


def lead_summary(spark: SparkSession, sf: str) -> DataFrame:
    return summarize.lead_summary(b.summaries(spark, sf), "article").select("article_id", "summary")


def sentence_scores(spark: SparkSession, sf: str) -> DataFrame:
    scores = summarize.sentence_scores(b.summaries(spark, sf), "article_id", "article")
    return scores.select("article_id", F.col("pos").cast("bigint").alias("pos"), "score")


def extractive_summary(spark: SparkSession, sf: str) -> DataFrame:
    return summarize.extractive_summary(b.summaries(spark, sf), "article_id", "article").select(
        "article_id", "summary"
    )


def extractive_summary_blocked(spark: SparkSession, sf: str) -> DataFrame:
    return summarize.extractive_summary(
        b.summaries(spark, sf), "article_id", "article", no_repeat_ngram=3
    ).select("article_id", "summary")


def block_repeats(spark: SparkSession, sf: str) -> DataFrame:
    """Sentences ranked by position; later repeats of a 3-gram go."""
    sents = b.summaries(spark, sf).select("article_id", tx.sentences(F.col("article")).alias("kept"))
    kept = summarize.block_repeats(sents, "kept")
    # the outer form: for the inner one the choice would also be made below, in a filter on its size
    return kept.select("article_id", F.inline_outer("kept")).where("pos IS NOT NULL")


def _lead_sizes() -> dict[str, int]:
    """A lead summary of its own length for each configured variant."""
    return {model: 10 * (i + 1) for i, (model, _) in enumerate(summarize.model_variants())}


def _leads(spark: SparkSession, sf: str) -> tuple[DataFrame, dict[str, Column]]:
    """Articles cut into words once, and each variant's summary from those."""
    words = tx.words(F.col("article")).alias("words")
    cut = b.summaries(spark, sf).select("article_id", F.slice(words, 1, max(_lead_sizes().values())).alias("words"))
    return cut, {m: F.array_join(F.slice("words", 1, n), " ") for m, n in _lead_sizes().items()}


def compare_models(spark: SparkSession, sf: str) -> DataFrame:
    return summarize.compare_models(*_leads(spark, sf), keep=["article_id"])


def compare_models_wide(spark: SparkSession, sf: str) -> DataFrame:
    return summarize.compare_models_wide(*_leads(spark, sf), keep=["article_id"])


def score_models(spark: SparkSession, sf: str) -> DataFrame:
    return summarize.score_leads(b.summaries(spark, sf), "article", "highlights", _lead_sizes())


def write_results_json(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch.new_path(spark, "results_json")
    io.write_results_json(summarize_corpus(spark, sf), path)
    return io.read_results_json(spark, path, PREDICTION)


# --- experiment runs -------------------------------------------------------


def load_scalars(spark: SparkSession, sf: str) -> DataFrame:
    """Scalars landed as CSV per run, with one unreadable line per run, read back."""
    scanned = scalar_io.scan_partitioned_scalars(spark, _land_scalars(spark, sf))
    return scalar_io.good_scalars(scanned)


def load_scalars_wide(spark: SparkSession, sf: str) -> DataFrame:
    """Every second run in the wide layout, the others in the long one; one is missing."""
    path = scratch.new_path(spark, "scalar_logs")
    wide = F.substring("run", 4, 2).cast("int") % 2 == 0
    logged = b.scalars(spark, sf)
    as_wide = runs.scalars_to_wide(logged.where(wide), list(b.TAGS.values()))
    for rows in (as_wide, logged.where(~wide).select("value", "run", "tag", "step")):
        rows.write.mode("append").option("header", True).partitionBy("run").csv(path)
    return scalar_io.load_scalars(spark, _run_paths(path)).drop("seq")


def load_scalars_report(spark: SparkSession, sf: str) -> DataFrame:
    return scalar_io.load_report(scalar_io.scan_scalars(spark, _run_paths(_land_scalars(spark, sf))))


def _run_paths(path: str) -> dict[str, str]:
    """Twelve runs that logged and one that did not."""
    return {f"run{k}": f"{path}/run=run{k}" for k in range(13)}


def _land_scalars(spark: SparkSession, sf: str) -> str:
    path = scratch.new_path(spark, "scalar_logs")
    good = b.scalars(spark, sf).select(
        F.col("step").cast("string").alias("step"), "tag", "value", "seq", "run"
    )
    # the first event of each run is written a second time with a broken step
    bad = good.where(F.col("step") == "1").withColumn("step", F.lit("not-a-number"))
    good.unionByName(bad).write.option("header", True).partitionBy("run").csv(path)
    return path


def scalars_to_wide(spark: SparkSession, sf: str) -> DataFrame:
    return runs.scalars_to_wide(b.scalars(spark, sf), list(b.TAGS.values()))


def scalars_to_long(spark: SparkSession, sf: str) -> DataFrame:
    wide = runs.scalars_to_wide(b.scalars(spark, sf), list(b.TAGS.values()))
    return runs.scalars_to_long(wide)


def loss_curves(spark: SparkSession, sf: str) -> DataFrame:
    return runs.loss_curves(b.scalars(spark, sf))


def last_metric(spark: SparkSession, sf: str) -> DataFrame:
    return runs.last_metric(b.scalars(spark, sf), list(runs.ROUGE_TAGS.values()))


def gpu_mean(spark: SparkSession, sf: str) -> DataFrame:
    return _single(runs.gpu_mean(b.scalars(spark, sf)), "gpu_avg")


def train_minutes(spark: SparkSession, sf: str) -> DataFrame:
    return _single(runs.train_minutes(b.scalars(spark, sf)), "train_time_min")


def _run_summary(spark: SparkSession, sf: str) -> DataFrame:
    # run12 is listed but logged nothing
    listed = [(f"run{i}",) for i in range(13)]
    return runs.run_summary(b.scalars(spark, sf), spark.createDataFrame(listed, "run string"))


def run_summary(spark: SparkSession, sf: str) -> DataFrame:
    return _single(_run_summary(spark, sf), "gpu_avg", "train_time_min")


def ema(spark: SparkSession, sf: str) -> DataFrame:
    smoothed = runs.ema(b.scalars(spark, sf), alpha=0.3, indexed=True)
    return _single(smoothed.select("run", "tag", "step", "ema"), "ema")


def valid_runs(spark: SparkSession, sf: str) -> DataFrame:
    return runs.valid_runs(b.scalars(spark, sf))


def label_runs(spark: SparkSession, sf: str) -> DataFrame:
    labels = runs.labels_frame(spark, b.RUN_LABELS)
    labelled = runs.label_runs(_run_summary(spark, sf).select("run", "rouge1"), labels)
    return labelled


def rouge_by_run(spark: SparkSession, sf: str) -> DataFrame:
    return runs.rouge_by_run(_run_summary(spark, sf))


def best_checkpoint(spark: SparkSession, sf: str) -> DataFrame:
    return runs.best_checkpoint(b.scalars(spark, sf), runs.EVAL_LOSS)


def best_checkpoint_rouge(spark: SparkSession, sf: str) -> DataFrame:
    return runs.best_checkpoint(b.scalars(spark, sf), "eval/rouge1")


def early_stop_step(spark: SparkSession, sf: str) -> DataFrame:
    return runs.early_stop_step(b.scalars(spark, sf), runs.EVAL_LOSS, patience=3)


def keep_last_checkpoints(spark: SparkSession, sf: str) -> DataFrame:
    evals = b.scalars(spark, sf).where(F.col("tag") == runs.EVAL_LOSS)
    return runs.keep_last_checkpoints(evals, 10, runs.best_checkpoint(evals, runs.EVAL_LOSS))


# --- SQL functions ---------------------------------------------------------


def sql_chunk_text(spark: SparkSession, sf: str) -> DataFrame:
    sqlf.register(spark)
    b.documents(spark, sf).createOrReplaceTempView("newscorpus_documents")
    return spark.sql(
        """SELECT d.doc_id, CAST(c.chunk_no AS BIGINT) AS chunk_no, c.chunk
           FROM newscorpus_documents d, LATERAL chunk_text(d.text, 256) AS c"""
    )


def sql_functions(spark: SparkSession, sf: str) -> DataFrame:
    sqlf.register(spark)
    b.documents(spark, sf).createOrReplaceTempView("newscorpus_documents")
    return spark.sql(
        """SELECT doc_id, word_count(text) AS n_words,
                  array_join(rouge_tokens(text), ' ') AS tokens,
                  round(element_at(ema(array(CAST(n_chars AS DOUBLE), CAST(doc_id AS DOUBLE),
                                             CAST(length(source) AS DOUBLE)), 0.3D), -1), 4) AS smoothed
           FROM newscorpus_documents"""
    )


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        pending_queries,
        page_plan,
        flatten_articles,
        append_read_articles,
        csv_round_trip,
        day_slice,
        drop_missing,
        dedupe_keep_first,
        dedupe_by_text,
        detect_language,
        filter_language,
        language_report,
        extract_body_flat,
        extract_body_nested,
        extract_body_rules,
        extract_body_sites,
        daily_curation,
        incremental_curation,
        run_day_round_trip,
        rerun_day,
        reject_report,
        curated_length_report,
        head_sample,
        nested_samples,
        split_train_val,
        split_by_modulus,
        select_pair_columns,
        add_task_prefix,
        build_vocab,
        encode_pairs,
        encode_pairs_joined,
        pad_fixed,
        pad_longest,
        decode_ids,
        decode_ids_joined,
        chunk_text,
        text_lengths,
        length_report,
        avg_length,
        length_histogram,
        top_words,
        top_bigrams,
        term_weights,
        category_counts,
        event_type_counts,
        extract_entities,
        rouge_tokens,
        rouge_tokens_stemmed,
        rouge_1,
        rouge_2,
        rouge_l,
        rouge_lsum,
        rouge_corpus,
        rouge_corpus_by_turn,
        rouge_corpus_lcs,
        rouge_corpus_stemmed,
        rouge_bootstrap,
        gen_len,
        write_eval_metrics,
        summarize_corpus,
        lead_summary,
        sentence_scores,
        extractive_summary,
        extractive_summary_blocked,
        block_repeats,
        compare_models,
        compare_models_wide,
        score_models,
        write_results_json,
        load_scalars,
        load_scalars_wide,
        load_scalars_report,
        scalars_to_wide,
        scalars_to_long,
        loss_curves,
        last_metric,
        gpu_mean,
        train_minutes,
        run_summary,
        ema,
        valid_runs,
        label_runs,
        rouge_by_run,
        best_checkpoint,
        best_checkpoint_rouge,
        early_stop_step,
        keep_last_checkpoints,
        sql_chunk_text,
        sql_functions,
    )
}
