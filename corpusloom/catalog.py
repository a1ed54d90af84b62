"""Named queries over the test tables, one or more per operator."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom import fixtures as fx
from corpusloom.functions.packing import sum_by_words
from corpusloom.functions.reports import to_html, to_text, url_object_key
from corpusloom.functions.stemming import stem_word, stem_words
from corpusloom.functions.text import tokens
from corpusloom.functions.vectors import aligned, array_measures
from corpusloom.operators import arcs, association, ngrams, similarity, tasks
from corpusloom.plans import next_word
from corpusloom.plans.similarity import corpus_statistics, gold_similarity
from corpusloom.sources import matrices
from corpusloom.sources.corpus import (
    gold_pairs,
    numbered_shards,
    read_arc_lines,
    read_gold_pairs,
    read_ngrams,
    read_vocabulary,
    select_input_files,
)
from corpusloom.sources.documents import documents_by_url, newest_landed_files, parse_tasks, read_tasks, write_ordered_text, write_outputs
from corpusloom.sources.sequence import read_sequence_lines, write_sequence_lines
from corpusloom.streaming import completion, jobs
from corpusloom.workspace import materialize, new_path, passing_tables, settle

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(build: Query) -> Query:
    QUERIES[build.__name__] = build
    return build


def _rounded(df: DataFrame, *names: str) -> DataFrame:
    return df.withColumns({name: F.round(name, 6) for name in names})


# Trigram counts and the next-word model


@query
def trigram_counts(spark, sf_dir):
    return fx.tri(spark, sf_dir)


@query
def unigram_counts(spark, sf_dir):
    return ngrams.unigram_counts(fx.tri(spark, sf_dir))


@query
def unigrams_from_bigrams(spark, sf_dir):
    return ngrams.fold_unigrams(ngrams.bigram_counts(fx.tri(spark, sf_dir)))


@query
def bigram_counts(spark, sf_dir):
    return ngrams.bigram_counts(fx.tri(spark, sf_dir))


@query
def corpus_total(spark, sf_dir):
    return ngrams.corpus_total(fx.trigram_rows(spark, sf_dir))


def _by_ngram(good):
    return sum_by_words(good, ["w1", "w2", "w3"], {"cnt": F.sum("cnt"), "last_year": F.max("year")})


@query
def ngram_line_filter(spark, sf_dir):
    good = ngrams.accepted_ngrams(fx.ngram_lines(spark, sf_dir, written=True))
    return _by_ngram(good)


@query
def ngram_line_rejects(spark, sf_dir):
    return ngrams.rejected_ngrams(fx.ngram_lines(spark, sf_dir))


@query
def stopword_filter(spark, sf_dir):
    trigrams = fx.tri(spark, sf_dir)
    return ngrams.drop_stopword_ngrams(trigrams, fx.stopword_list(trigrams))


@query
def rare_word_filter(spark, sf_dir):
    """Trigrams without a word of a long list."""
    trigrams = settle(fx.tri(spark, sf_dir), "trigrams")
    return ngrams.drop_stopword_ngrams(trigrams, fx.rare_words(trigrams), in_steps=True)


@query
def fivegram_counts(spark, sf_dir):
    grams = ngrams.ngrams(fx.documents(spark, sf_dir), 5)
    return grams.groupBy(F.array_join("gram", " ").alias("gram")).agg(F.sum("cnt").alias("cnt"))


@query
def ngram_files(spark, sf_dir):
    """The n-gram lines as text files, read back."""
    path = new_path(spark, "ngram-lines")
    with passing_tables(spark):
        # Packed files, as a text of all lines would be larger than any shuffle.
        fx.ngram_lines(spark, sf_dir, written=True).write.text(path, compression="gzip")
    good = read_ngrams(spark, path, "text")
    return _by_ngram(good)


@query
def ngram_sequence(spark, sf_dir):
    """The n-gram lines as sequence files, read back in splits smaller than a file."""
    path = new_path(spark, "ngram-sequence")
    with passing_tables(spark):
        write_sequence_lines(fx.ngram_lines(spark, sf_dir, written=True), path)
    good = ngrams.accepted_ngrams(read_sequence_lines(spark, path, 1 << 20))
    return _by_ngram(good)


@query
def ngram_tables(spark, sf_dir):
    """Trigram rows of every source as parquet, read back."""
    path = new_path(spark, "ngram-table")
    rows = fx.trigram_rows_by_source(spark, sf_dir)
    rows.select("w1", "w2", "w3", F.lit(2000).alias("year"), "cnt").write.parquet(path)
    return ngrams.trigram_counts(read_ngrams(spark, path))


@query
def ngram_shards(spark, sf_dir):
    """Shards by source, some of them chosen by number and by path before reading."""
    path = new_path(spark, "ngram-shards")
    rows = fx.trigram_rows_by_source(spark, sf_dir)
    rows.withColumn("year", F.lit(2000)).filter(F.col("source").rlike("^src[0-9]$")).write.partitionBy("source").parquet(path)
    shards = numbered_shards(path + "/source=src{}", range(10))
    return ngrams.trigram_counts(read_ngrams(spark, select_input_files(shards, lambda shard: shard[-1] in "037")))


@query
def stopword_filter_inline(spark, sf_dir):
    listed = ["the", "and", "of", "la", "le", "der", "die", "und", "de", "."]
    return ngrams.drop_stopword_ngrams(fx.tri(spark, sf_dir), listed)


@query
def ngram_roles(spark, sf_dir):
    """Distinct grams and counts by role and first word."""
    roles = ngrams.ngram_roles(fx.tri(spark, sf_dir))
    word = F.coalesce(F.get("gram", F.lit(0)), F.lit(""))
    return roles.groupBy("role", word.alias("word")).agg(F.count(F.lit(1)).alias("n"), F.sum("cnt").alias("cnt"))


@query
def gram_tags(spark, sf_dir):
    """Every gram of every trigram tagged by the part it plays, tallied."""
    roles = ngrams.ngram_roles(fx.tri(spark, sf_dir))
    tags = F.array_join(F.array_sort(ngrams.tag_parameter(F.col("gram"))), "+")
    return roles.groupBy("role", tags.alias("tags")).agg(F.count(F.lit(1)).alias("n"), F.sum("cnt").alias("cnt"))


@query
def tag_parameters(spark, sf_dir):
    return ngrams.assemble_params(fx.trigram_rows(spark, sf_dir), in_steps=True)


@query
def next_word_prob(spark, sf_dir):
    return _rounded(next_word.next_word_prob(fx.trigram_rows(spark, sf_dir), in_steps=True), "prob")


@query
def next_word_prob_as_written(spark, sf_dir):
    scored = next_word.scored_trigrams(fx.trigram_rows(spark, sf_dir), as_written=True, in_steps=True)
    return _rounded(scored, "prob")


@query
def next_word_prob_no_stopwords(spark, sf_dir):
    # Counted once: the list and what is left of the trigrams both come from their counts.
    trigrams = settle(fx.tri(spark, sf_dir), "trigrams")
    kept = ngrams.drop_stopword_ngrams(trigrams, fx.stopword_list(trigrams), in_steps=True)
    return _rounded(next_word.scored_trigrams(kept, in_steps=True), "prob")


def _scored(spark, sf_dir):
    """The scored trigrams, written; the tables behind them are gone."""
    with passing_tables(spark):
        # Rounding first makes ties, and so the order, the same in every engine.
        scored = _rounded(next_word.scored_trigrams(fx.trigram_rows(spark, sf_dir), in_steps=True), "prob")
        return settle(scored, "scored", keep=1)


@query
def rank_continuations(spark, sf_dir):
    with passing_tables(spark):
        return next_word.rank_continuations(_scored(spark, sf_dir))


@query
def top_next_5(spark, sf_dir):
    return next_word.top_next(_scored(spark, sf_dir), 5)


@query
def ranked_text(spark, sf_dir):
    """The ranked text file, written and read back line by line in its order."""
    path = new_path(spark, "ranked-text")
    with passing_tables(spark):
        matrices.write_ranked_text(_scored(spark, sf_dir), path)
    return matrices.read_ranked_text(spark, path)


@query
def shard_sample(spark, sf_dir):
    """Counts over some sources only, chosen like files of a sharded corpus."""
    rows = fx.trigram_rows_by_source(spark, sf_dir)
    return ngrams.trigram_counts(rows.filter(F.col("source").isin("src0", "src3", "src7")))


@query
def union_of_sources(spark, sf_dir):
    """Documents and conversations read as one corpus."""
    talk = fx.table(spark, sf_dir, "conversations").select("text")
    docs = fx.documents(spark, sf_dir).select("text")
    return ngrams.unigram_counts(ngrams.trigram_counts(ngrams.sliding_trigrams(docs.unionByName(talk))))


# Dependency arcs


def _arc_lines(spark, sf_dir, written=False):
    """Trigrams and their good arc lines; ``written`` where the vocabulary is read first, so that trigrams are counted once."""
    trigrams = fx.tri(spark, sf_dir)
    if written:
        trigrams = settle(trigrams, "trigrams")
    return trigrams, arcs.accepted_arc_lines(fx.arc_lines(trigrams))


def _statistics(spark, sf_dir, stem=None):
    trigrams, lines = _arc_lines(spark, sf_dir, written=True)
    words = fx.vocabulary(trigrams)
    if stem:
        words = words.select(F.get(stem(F.array("lexeme")), F.lit(0)).alias("lexeme"))
    return words, arcs.arc_statistics(arcs.with_arcs(lines, stem), words)


@query
def arc_line_filter(spark, sf_dir):
    """Token counts and sums of the lines that parse."""
    _, lines = _arc_lines(spark, sf_dir)
    return lines.groupBy(F.size("toks").alias("n_toks")).agg(F.count(F.lit(1)).alias("n"), F.sum("cnt").alias("cnt"))


def _by_arc(rows):
    return sum_by_words(rows, ["lexeme", "dep", "head"], {"n": F.count(F.lit(1)), "cnt": F.sum("cnt")})


@query
def arc_files(spark, sf_dir):
    """The arc lines as text files, read back."""
    path = new_path(spark, "arc-lines")
    with passing_tables(spark):
        trigrams = settle(fx.tri(spark, sf_dir), "trigrams")
        # Packed files, as a text of all lines would be larger than any shuffle.
        fx.arc_lines(trigrams).write.text(path, compression="gzip")
    return _by_arc(arcs.explode_arcs(arcs.with_arcs(read_arc_lines(spark, path))))


@query
def arc_line_rejects(spark, sf_dir):
    return arcs.rejected_arc_lines(fx.arc_lines(fx.tri(spark, sf_dir)))


@query
def arc_explode(spark, sf_dir):
    """Every arc, summed by its ends and label."""
    _, lines = _arc_lines(spark, sf_dir, written=True)
    return _by_arc(arcs.explode_arcs(arcs.with_arcs(lines)))


@query
def arc_valid(spark, sf_dir):
    """Lines by number of tokens and of arcs left."""
    _, lines = _arc_lines(spark, sf_dir)
    counted = arcs.with_arcs(lines).groupBy("n_toks", F.size("arcs").alias("n_arcs"))
    return counted.agg(F.count(F.lit(1)).alias("n"), F.sum("cnt").alias("cnt"))


@query
def line_distinct_features(spark, sf_dir):
    """Lines by number of arcs and of different features."""
    _, lines = _arc_lines(spark, sf_dir)
    features = F.size(arcs.distinct_features(F.col("arcs"))).alias("n_features")
    counted = arcs.with_arcs(lines).groupBy(F.size("arcs").alias("n_arcs"), features)
    return counted.agg(F.count(F.lit(1)).alias("n"), F.sum("cnt").alias("cnt"))


@query
def vocabulary_words(spark, sf_dir):
    """The vocabulary as a side file: padded and repeated lines, read back."""
    words = fx.vocabulary(fx.tri(spark, sf_dir))
    path = new_path(spark, "vocabulary")
    padded = words.select(F.concat(F.lit("  "), "lexeme", F.lit(" ")).alias("value"))
    padded.unionByName(words.select(F.col("lexeme").alias("value"))).write.text(path)
    return read_vocabulary(spark, path)


@query
def vocabulary_arcs(spark, sf_dir):
    """Arcs of vocabulary words by semi join."""
    trigrams, lines = _arc_lines(spark, sf_dir)
    rows = arcs.explode_arcs(arcs.with_arcs(lines))
    # The sums come first: of the arcs only words and labels meet the vocabulary.
    sums = rows.groupBy("lexeme", "dep").agg(F.count(F.lit(1)).alias("n"), F.sum("cnt").alias("cnt"))
    return arcs.in_vocabulary(sums, fx.vocabulary(trigrams))


@query
def pair_counts(spark, sf_dir):
    return arcs.pair_counts(_statistics(spark, sf_dir)[1])


@query
def lexeme_counts(spark, sf_dir):
    return arcs.lexeme_counts(_statistics(spark, sf_dir)[1])


@query
def feature_counts(spark, sf_dir):
    return arcs.feature_counts(_statistics(spark, sf_dir)[1])


@query
def global_counts(spark, sf_dir):
    return arcs.global_counts(_statistics(spark, sf_dir)[1])


@query
def count_rejects(spark, sf_dir):
    """Counts beyond 64 bits, in a corpus whose lines have counts up to that."""
    trigrams, lines = _arc_lines(spark, sf_dir, written=True)
    large = F.when(F.size("toks") == 3, F.least("cnt", F.lit(922)) * fx.LARGE).otherwise(F.col("cnt"))
    # Written, as every kind of count reads them.
    return arcs.count_rejects(corpus_statistics(lines.withColumn("cnt", large), fx.vocabulary(trigrams)))


@query
def top_features(spark, sf_dir):
    return arcs.top_features(arcs.feature_counts(_statistics(spark, sf_dir)[1]))


def _assoc(spark, sf_dir):
    """Vocabulary, written statistics and associations of the arc corpus."""
    trigrams, lines = _arc_lines(spark, sf_dir, written=True)
    words = materialize(fx.vocabulary(trigrams), "vocabulary")
    stats = corpus_statistics(lines, words)
    return words, stats, association.assoc_from_statistics(stats)


@query
def assoc_measures(spark, sf_dir):
    return _rounded(_assoc(spark, sf_dir)[2], "freq", "prob", "pmi", "ttest")


@query
def dense_vectors(spark, sf_dir):
    """Every cell of the dense vectors."""
    _, stats, assoc = _assoc(spark, sf_dir)
    vectors = association.dense_vectors(assoc, arcs.lexeme_counts(stats))
    cells = vectors.select("lexeme", "eq", F.posexplode("vector").alias("feature_idx", "value"))
    return _rounded(cells, "value")


@query
def vector_text(spark, sf_dir):
    """Dense vectors written as text, read back, and made sparse again."""
    _, stats, assoc = _assoc(spark, sf_dir)
    path = new_path(spark, "vectors")
    matrices.write_vectors(association.dense_vectors(assoc, arcs.lexeme_counts(stats)), path, "text")
    sparse = association.sparse_from_dense(matrices.read_vectors(spark, path, "text"))
    return _rounded(sparse, "freq", "prob", "pmi", "ttest")


@query
def gold_pairs_canonical(spark, sf_dir):
    words = fx.vocabulary(fx.tri(spark, sf_dir))
    return similarity.canonical_pairs(gold_pairs(fx.gold_lines(words)))


@query
def gold_pair_files(spark, sf_dir):
    """Gold lines as text files, the lines of a pair in one file in their order, read back by line number."""
    path = new_path(spark, "gold-lines")
    words = F.split("value", "\t")
    pair = F.array_sort(F.slice(words, 1, 2))
    lines = fx.gold_lines(fx.vocabulary(fx.tri(spark, sf_dir))).repartition(pair).sortWithinPartitions("line_no")
    lines.select("value").write.text(path)
    return similarity.canonical_pairs(read_gold_pairs(spark, path))


@query
def count_tables(spark, sf_dir):
    """The lexeme counts as a table of their own, read back."""
    path = new_path(spark, "lexeme-counts")
    matrices.write_counts(arcs.lexeme_counts(_statistics(spark, sf_dir)[1]), path)
    return matrices.read_counts(spark, path)


@query
def gold_pairs_as_written(spark, sf_dir):
    words = fx.vocabulary(fx.tri(spark, sf_dir))
    return similarity.canonical_pairs(gold_pairs(fx.gold_lines(words)), as_written=True)


@query
def gold_pairs_counted(spark, sf_dir):
    words, stats, _ = _assoc(spark, sf_dir)
    return similarity.counted_pairs(similarity.canonical_pairs(gold_pairs(fx.gold_lines(words))), arcs.lexeme_counts(stats))


def _similarity(spark, sf_dir, stem=None):
    trigrams, lines = _arc_lines(spark, sf_dir, written=True)
    words = materialize(fx.vocabulary(trigrams), "vocabulary")
    gold = gold_pairs(fx.gold_lines(words))
    if stem:
        words = words.select(F.get(stem(F.array("lexeme")), F.lit(0)).alias("lexeme"))
    return gold_similarity(lines, words, gold, stem)


@query
def pair_similarity_24(spark, sf_dir):
    return _rounded(_similarity(spark, sf_dir), *similarity.FEATURES)


@query
def similarity_text(spark, sf_dir):
    """The feature matrix written as text and read back line by line in its order."""
    path = new_path(spark, "similarity")
    matrices.write_similarity(_similarity(spark, sf_dir), path, "text")
    return _rounded(matrices.read_similarity_text(spark, path), *similarity.FEATURES)


@query
def embedding_pair_measures(spark, sf_dir):
    pairs = fx.embedding_pairs(fx.table(spark, sf_dir, "embeddings"))
    measures = array_measures(aligned(F.col("a"), F.col("b")))
    return pairs.select("vec_id", *[F.round(value, 6).alias(name) for name, value in measures.items()])


@query
def stemmed_words(spark, sf_dir):
    """Every different word with its stem."""
    words = fx.documents(spark, sf_dir).select(F.explode(tokens(F.col("text"))).alias("word")).distinct()
    return words.select("word", stem_word("word").alias("stem"))


@query
def stemmed_feature_counts(spark, sf_dir):
    """Feature counts with both ends of every arc stemmed."""
    return arcs.feature_counts(_statistics(spark, sf_dir, stem_words)[1])


@query
def stemmed_pair_similarity(spark, sf_dir):
    """The feature matrix of stemmed words."""
    return _rounded(_similarity(spark, sf_dir, stem_words), *similarity.FEATURES)


# Document jobs


def _tasks(spark, sf_dir):
    pages = fx.table(spark, sf_dir, "pages")
    return parse_tasks(fx.task_lines(pages), "line_no"), documents_by_url(fx.landed_documents(pages))


def _asked(spark, sf_dir):
    """Tasks and the documents they ask for."""
    pages = fx.table(spark, sf_dir, "pages")
    todo = parse_tasks(fx.task_lines(pages), "line_no")
    return todo, documents_by_url(fx.landed_documents(pages), todo)


def _results(spark, sf_dir):
    return tasks.convert_tasks(*_asked(spark, sf_dir))


@query
def submissions(spark, sf_dir):
    return tasks.submissions(fx.messages(fx.table(spark, sf_dir, "pages")))


@query
def stop_requests(spark, sf_dir):
    return tasks.stop_requests(fx.messages(fx.table(spark, sf_dir, "pages")))


@query
def tasks_per_app(spark, sf_dir):
    return tasks.tasks_per_app(_tasks(spark, sf_dir)[0])


@query
def target_partitions(spark, sf_dir):
    return tasks.parallelism_per_app(_tasks(spark, sf_dir)[0], 10)


@query
def documents_newest(spark, sf_dir):
    return _tasks(spark, sf_dir)[1]


@query
def content_problems(spark, sf_dir):
    docs = _tasks(spark, sf_dir)[1]
    problem = tasks.content_problem(F.col("http_status"), F.col("content_type"))
    return docs.select("url", problem.alias("problem")).filter(F.col("problem").isNotNull())


@query
def convert_to_html(spark, sf_dir):
    pages = fx.landed_documents(fx.table(spark, sf_dir, "pages"))
    return pages.select("url", "fetched_at", to_html(F.col("body")).alias("output"))


@query
def convert_to_text(spark, sf_dir):
    pages = fx.landed_documents(fx.table(spark, sf_dir, "pages"))
    return pages.select("url", "fetched_at", to_text(F.col("body")).alias("output"))


@query
def convert_results(spark, sf_dir):
    return _results(spark, sf_dir)


@query
def job_parts(spark, sf_dir):
    """Results by job, and the parts in which they come."""
    results = tasks.convert_tasks(*_asked(spark, sf_dir), per_worker=10)
    sums = results.groupBy("app_id").agg(F.countDistinct("part").alias("parts"), F.count(F.lit(1)).alias("n"), F.count_if(F.col("status") == "success").alias("n_success"))
    return sums


@query
def landed_newest(spark, sf_dir):
    """Pages landed as files, some twice; the newest file of every page, read where it is given out."""
    path = new_path(spark, "landed")
    fx.write_landed_files(fx.table(spark, sf_dir, "pages"), path)
    docs = newest_landed_files(spark, path, fx.PAGE_OF_FILE)
    return docs.select(F.col("url").cast("bigint").alias("page_id"), F.md5("body").alias("digest"), F.octet_length("body").cast("bigint").alias("size"))


@query
def convert_by_user(spark, sf_dir):
    """ToImage by a function that gives bytes and fails on some documents."""

    def image(body: str) -> bytes:
        if len(body) % 3 == 0:
            raise ValueError("no page to draw")
        return body.encode()

    results = tasks.convert_tasks(*_asked(spark, sf_dir), {"ToImage": image})
    return results.withColumn("digest", F.md5("data")).drop("data")


@query
def result_lines(spark, sf_dir):
    return tasks.result_lines(_results(spark, sf_dir))


@query
def collect_results(spark, sf_dir):
    return tasks.collect_results(tasks.result_lines(_results(spark, sf_dir)))


@query
def report_lines(spark, sf_dir):
    lines = tasks.result_lines(_results(spark, sf_dir))
    shown = tasks.report_line(F.col("line")).alias("shown")
    return lines.select("app_id", "line_no", tasks.report_class(F.col("line")).alias("report_class"), shown)


@query
def render_report(spark, sf_dir):
    return tasks.render_report(tasks.result_lines(_results(spark, sf_dir)))


@query
def report_files(spark, sf_dir):
    """Report pages written as text; lines read back by job."""
    path = new_path(spark, "reports")
    write_ordered_text(tasks.render_report(tasks.result_lines(_results(spark, sf_dir))), path)
    pages = spark.read.schema("value string, app_id string").text(path)
    return pages.groupBy("app_id", "value").agg(F.count(F.lit(1)).alias("n"))


@query
def output_files(spark, sf_dir):
    """Converted texts written by job and operation, read back."""
    path = new_path(spark, "outputs")
    write_outputs(_results(spark, sf_dir), path)
    schema = "line_no bigint, url string, output string, app_id string, op string"
    return spark.read.schema(schema).parquet(path)


@query
def status_summary(spark, sf_dir):
    return tasks.status_summary(tasks.result_lines(_results(spark, sf_dir)))


@query
def url_object_keys(spark, sf_dir):
    pages = fx.escaped_urls(fx.table(spark, sf_dir, "pages"))
    return pages.select("page_id", url_object_key(F.col("url")).alias("object_key"))


@query
def results_deduped(spark, sf_dir):
    return tasks.dedupe_results(fx.deliveries(fx.table(spark, sf_dir, "events")), "arrival")


@query
def job_progress(spark, sf_dir):
    events = fx.table(spark, sf_dir, "events")
    return tasks.job_progress(fx.deliveries(events), fx.announced_jobs(events))


@query
def job_complete(spark, sf_dir):
    events = fx.table(spark, sf_dir, "events")
    return tasks.completed_jobs(fx.deliveries(events), fx.announced_jobs(events))


def _event_stream(spark, sf_dir):
    schema = fx.table(spark, sf_dir, "events").schema
    return jobs.read_stream(spark, sf_dir, schema, glob="events.parquet")


@query
def stream_completion(spark, sf_dir):
    """Completion found by the stream, half of the jobs announced only in a second run, after all their results came in."""
    told = fx.announced_jobs(fx.table(spark, sf_dir, "events"))
    landed, path, state = (new_path(spark, name) for name in ("announced", "completed", "completed-state"))
    late = F.col("app_id").cast("bigint") % 2 == 0
    told.filter(~late).write.parquet(landed)

    def start():
        announced = jobs.read_stream(spark, landed, told.schema)
        return completion.follow_jobs(fx.deliveries(_event_stream(spark, sf_dir)), announced, path, state)

    start().awaitTermination()
    told.filter(late).write.mode("append").parquet(landed)
    start().awaitTermination()
    return completion.completed_jobs(spark, path)


@query
def stream_summaries(spark, sf_dir):
    """Task files that arrive one by one are converted and summed up when a job is complete; both streams stop half-way.

    The last runs find nothing new and add nothing.
    """
    pages = fx.table(spark, sf_dir, "pages")
    landed = materialize(documents_by_url(fx.landed_documents(pages)), "documents")
    lines = materialize(fx.task_lines(pages), "task-lines")
    arriving, path, tasks_state, jobs_state = (new_path(spark, name) for name in ("task-files", "summaries", "tasks-state", "jobs-state"))

    def run():
        arrived = jobs.read_task_stream(spark, arriving, 1, fx.JOB_OF_FOLDER)
        jobs.convert_task_files(arrived, landed, path, tasks_state).awaitTermination()
        completion.settle(spark, f"{path}/jobs", lambda: jobs.summarise_jobs(spark, path, jobs_state))

    fx.write_task_files(lines.filter("app_id IN ('1', '2')"), arriving)
    run()
    fx.write_task_files(lines.filter("app_id NOT IN ('1', '2')"), arriving)
    run()
    run()
    return jobs.read_summaries(spark, path)


@query
def task_files(spark, sf_dir):
    """Task lists as files, one per job, read back by line number."""
    path = new_path(spark, "task-lists")
    fx.write_task_files(fx.task_lines(fx.table(spark, sf_dir, "pages")), path)
    return read_tasks(spark, path, fx.JOB_OF_FOLDER)


@query
def stream_deduped_horizon(spark, sf_dir):
    """Each line once within the horizon: what is delivered again after its state was given up counts again.

    The deliveries arrive in slices of ten days, one run each.
    """
    sent = materialize(fx.timed_deliveries(fx.table(spark, sf_dir, "events")), "timed-deliveries")
    arriving, path, state = (new_path(spark, name) for name in ("slices", "deduped", "deduped-state"))
    for start, end in fx.slices(sent):
        sent.filter((F.col("at") >= start) & (F.col("at") < end)).write.mode("append").parquet(arriving)
        stream = jobs.dedupe_stream(jobs.read_stream(spark, arriving, sent.schema), "at", fx.HORIZON).select("app_id", "line_no")
        sink = stream.writeStream.format("parquet").outputMode("append").option("path", path).option("checkpointLocation", state)
        sink.trigger(availableNow=True).start().awaitTermination()
    kept = spark.read.schema("app_id string, line_no bigint").parquet(path)
    return kept.groupBy("app_id", "line_no").agg(F.count(F.lit(1)).alias("n"))


@query
def stream_deduped(spark, sf_dir):
    """Results of the stream, each line once, drained into files."""
    stream = fx.deliveries(_event_stream(spark, sf_dir)).select("app_id", "line_no")
    path = new_path(spark, "deduped")
    sink = jobs.dedupe_stream(stream).writeStream.format("parquet").outputMode("append")
    sink = sink.option("path", path).option("checkpointLocation", new_path(spark, "deduped-state"))
    sink.trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema("app_id string, line_no bigint").parquet(path)
