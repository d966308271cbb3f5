"""One query per operator, over the driver's tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftwork.functions import html, pii
from siftwork.functions import text as T
from siftwork.functions import urls as U
from siftwork.operators import classifiers as C
from siftwork.operators import exact_duplicates as X
from siftwork.operators import language as L
from siftwork.operators import near_duplicates as N
from siftwork.operators import domains, reports, rules, sampling
from siftwork.operators import tokens as K
from siftwork.operators.positions import zip_by_position
from siftwork.operators.softmax import softmax_scores, train_softmax
from siftwork.plans import curate as P
from siftwork.plans import english
from siftwork.plans import quality_model as Q
from siftwork.plans import sequences
from siftwork.session import materialize, scratch_path
from siftwork.sources import files, warc
from siftwork.sources.tables import read_table, spread
from siftwork.streaming.incremental import curate_incrementally, streamed_report

MINHASH = N.MinHashParameters(num_hashes=40, num_bands=10, ngrams=5, threshold=0.8)
LABEL_NAMES = {"quality": ("cc", "wiki"), "toxic": ("non-toxic", "toxic")}
HEADS = (C.QUALITY, C.TOXIC)
Query = Callable[[SparkSession, str], DataFrame]


# -- inputs ------------------------------------------------------------------------------------------------


def documents(spark: SparkSession, sf: str, *columns: str) -> DataFrame:
    return spread(read_table(spark, sf, "documents", list(columns) or ["doc_id", "text"]))


def pages(spark: SparkSession, sf: str, *columns: str) -> DataFrame:
    return spread(read_table(spark, sf, "pages", list(columns) or ["page_id", "html"]))


def labelled(spark: SparkSession, sf: str) -> DataFrame:
    """Documents with the class names of their labels."""
    labels = C.with_named_labels(read_table(spark, sf, "labels"), LABEL_NAMES)
    return documents(spark, sf).join(labels, "doc_id")


def models(spark: SparkSession, sf: str) -> P.Models:
    return P.Models(C.train(labelled(spark, sf), HEADS, C.WORDS), HEADS)


def judged(spark: SparkSession, sf: str) -> DataFrame:
    return P.judge(documents(spark, sf, "doc_id", "text", "source"), models(spark, sf), keep=("source",))


def language_model(spark: SparkSession, sf: str) -> L.LanguageModel:
    """Trained on three folds of the documents, calibrated on one; the last is left for evaluation."""
    docs = documents(spark, sf, "doc_id", "text", "lang").withColumn("fold", L.fold("doc_id"))
    model = L.train_languages(docs.where(~F.col("fold").isin(L.EVALUATION, L.CALIBRATION)))
    return L.calibrate(model, docs.where(F.col("fold") == L.CALIBRATION))


def held_out_languages(spark: SparkSession, sf: str) -> DataFrame:
    """``(doc_id, label, score, lang)`` of the documents of the evaluation fold."""
    docs = documents(spark, sf, "doc_id", "text", "lang").where(L.fold("doc_id") == L.EVALUATION)
    return L.identify(docs, language_model(spark, sf)).join(docs.select("doc_id", "lang"), "doc_id")


def languages(spark: SparkSession, sf: str) -> DataFrame:
    return L.identify(documents(spark, sf), language_model(spark, sf))


def examples(spark: SparkSession, sf: str) -> DataFrame:
    docs = materialize(labelled(spark, sf))  # texts meet their labels once, and are read by four steps
    harm = C.train(docs.drop("quality"), (C.TOXIC,), C.WORDS)
    return Q.select_examples(docs.withColumnRenamed("quality", "label"), language_model(spark, sf), harm, (C.TOXIC,))


# -- text and rules ----------------------------------------------------------------------------------------


def word_count(spark, sf):
    return documents(spark, sf).select("doc_id", T.word_count(F.col("text")).alias("n_words"))


def ws_normalize(spark, sf):
    return documents(spark, sf).select("doc_id", T.flatten_ws(F.col("text")).alias("text_norm"))


def normalize_text(spark, sf):
    return documents(spark, sf).select("doc_id", T.normalize_text(F.col("text")).alias("text_norm"))


def length_filter(spark, sf):
    counted = documents(spark, sf).select("doc_id", T.word_count(F.col("text")).alias("n_words"))
    return counted.withColumn("reason", rules.length_reason(F.col("n_words")))


def _masked_by(mask) -> Query:
    def query(spark, sf):
        masked, n = mask(F.col("text"))
        return documents(spark, sf).select("doc_id", masked.alias("masked"), n.alias("n"))

    return query


def pii_mask_all(spark, sf):
    docs = documents(spark, sf).withColumn("stripped", T.strip(F.col("text")))
    return pii.with_masked(docs, "stripped").select("doc_id", "masked", "n_email", "n_phone", "n_ip")


def pii_hits(spark, sf):
    hits = F.col("n_email") + F.col("n_phone") + F.col("n_ip")
    return sampling.first_matching(pii_mask_all(spark, sf), "doc_id", hits > 0, 20)


def quality_rules(spark, sf):
    return rules.with_rule_measures(documents(spark, sf)).select(
        "doc_id",
        "n_tokens",
        F.round("mean_len", 6).alias("mean_len"),
        F.round("ellipsis_share", 6).alias("ellipsis_share"),
        F.round("alpha_share", 6).alias("alpha_share"),
        rules.failed_rule().alias("failed_rule"),
    )


def quality_filter(spark, sf):
    measured = rules.with_rule_measures(documents(spark, sf))
    return measured.select("doc_id", rules.failed_rule().isNull().alias("passed"))


# -- curation and reports ----------------------------------------------------------------------------------


def rejection_reason(spark, sf):
    return judged(spark, sf).select("doc_id", "reason")


def filter_report(spark, sf):
    return reports.filter_report(judged(spark, sf))


def filter_report_by_source(spark, sf):
    return reports.filter_report_by_source(judged(spark, sf))


def filter_funnel(spark, sf):
    return reports.filter_funnel(judged(spark, sf))


def baseline_vs_final(spark, sf):
    return reports.baseline_vs_final(judged(spark, sf))


def curate_documents(spark, sf):
    docs = documents(spark, sf, "doc_id", "text", "source")
    return P.curate(docs, models(spark, sf)).select("doc_id", "source", "word_count", "text")


# -- duplicates --------------------------------------------------------------------------------------------


def exact_line_dedup(spark, sf):
    return X.drop_repeated_lines(documents(spark, sf)).select("doc_id", "text")


def exact_doc_dedup(spark, sf):
    return X.first_of_each_text(documents(spark, sf))


def exact_dedup_report(spark, sf):
    return X.document_dedup_report(documents(spark, sf))


def ngram_counts(spark, sf):
    return N.gram_counts(documents(spark, sf), MINHASH.ngrams)


def minhash_signature(spark, sf):
    return N.signatures(N.with_grams(documents(spark, sf), MINHASH.ngrams), MINHASH, ["doc_id"])


def lsh_candidates(spark, sf):
    return N.candidate_links(documents(spark, sf), MINHASH)


def lsh_buckets(spark, sf):
    return N.lsh_buckets(documents(spark, sf), MINHASH)


def jaccard_pairs(spark, sf):
    links = N.verified_links(documents(spark, sf), MINHASH)
    return links.select("a", "b", F.round("jaccard", 6).alias("jaccard"))


def dup_clusters(spark, sf):
    return N.duplicate_clusters(documents(spark, sf), MINHASH)


def fuzzy_dedup(spark, sf):
    return N.drop_near_duplicates(documents(spark, sf), MINHASH).select("doc_id")


# -- pages and URLs ----------------------------------------------------------------------------------------


def html_extract(spark, sf):
    return pages(spark, sf).select("page_id", html.extract_text(F.col("html")).alias("text"))


def extract_compare(spark, sf):
    """Two extractions of the same pages, joined on the page."""
    full = pages(spark, sf).select("page_id", html.extract_text(F.col("html")).alias("_full"))
    bare = pages(spark, sf).select("page_id", html.extract_text(F.col("html"), ("nav",)).alias("_bare"))
    shared = F.size(F.array_intersect(F.split("_full", "\n"), F.split("_bare", "\n")))
    return full.join(bare, "page_id").select(
        "page_id",
        F.length("_full").alias("n_full"),
        F.length("_bare").alias("n_no_nav"),
        shared.alias("shared_lines"),
    )


def zip_mismatches(spark, sf):
    """Pages against those of them that are not on a mobile host, both by page; where the same position holds another page."""
    left = pages(spark, sf, "page_id", "url")
    found = zip_by_position(left, left.where("NOT contains(url, '//m.')"), "page_id", ["page_id"])
    return found.where("NOT (left_status <=> 'equal' AND right_status <=> 'equal')")


def url_domain(spark, sf):
    found = domains.with_registered_domain(pages(spark, sf, "page_id", "url"), domains.suffixes(spark))
    return found.select("page_id", "domain")


#: Hosts of the tables are moved below these endings, which need every kind of rule.
ENDINGS = ("co.ke", "com.do", "bar.ck", "www.ck", "ck", "tokyo.jp", "city.kobe.jp", "x.kobe.jp", "co.uk", "nosuchsuffix", "com", "es")


def url_domain_rules(spark, sf):
    """Registered domains of the pages' hosts as they would be below other public suffixes."""
    first = F.get(F.split(U.host(F.col("url")), r"\."), F.lit(0))
    moved = pages(spark, sf, "page_id", "url").select(
        "page_id", first.alias("_first"), F.explode(F.array(*[F.lit(e) for e in ENDINGS])).alias("ending")
    )
    hosts = moved.select("page_id", "ending", F.concat(F.lit("https://www."), "_first", F.lit("."), "ending", F.lit("/")).alias("url"))
    return domains.with_registered_domain(hosts, domains.suffixes(spark)).select("page_id", "ending", "domain")


def valid_urls(spark, sf):
    return files.clean_urls(read_table(spark, sf, "pages", ["url"]))


def url_extract(spark, sf):
    """Each page is cited as in a wiki dump: its source, then an escaped reference to its URL, with a full stop."""
    lines = pages(spark, sf, "html", "url").select(
        F.concat(F.translate("html", "\n", " "), F.lit(" &lt;ref&gt;"), F.col("url"), F.lit(". &lt;/ref&gt; "), F.col("url")).alias("line")
    )
    return files.distinct_urls(lines.select(F.explode(U.reference_urls(F.col("line"))).alias("url")))


def url_sample(spark, sf):
    return sampling.seeded_sample(files.clean_urls(read_table(spark, sf, "pages", ["url"])), "url", 10_000)


def manifest_chunks(spark, sf):
    chunks = sampling.manifest_chunks(read_table(spark, sf, "pages", ["url"]), "url", 40, 4)
    return chunks.select("chunk", F.size("files").alias("n_files"), F.get("files", F.lit(0)).alias("first_url"))


# -- language ----------------------------------------------------------------------------------------------


def lang_id(spark, sf):
    return languages(spark, sf)


def english_filter(spark, sf):
    docs = documents(spark, sf)
    return english.english_documents(docs, language_model(spark, sf)).select("doc_id")


def english_text_share(spark, sf):
    docs = documents(spark, sf, "doc_id", "text").withColumn("n_chars", F.length("text"))
    found = L.identify(docs, language_model(spark, sf)).join(docs.select("doc_id", "n_chars"), "doc_id")
    kept = L.is_confident_english(F.col("label"), F.col("score"))
    return reports.kept_text_share(found, F.col("n_chars"), kept)


def langid_confusion(spark, sf):
    return reports.confusion(held_out_languages(spark, sf), "lang", "label")


def threshold_curve(spark, sf):
    found = held_out_languages(spark, sf)
    return reports.threshold_curve(found, F.col("score"), F.col("label") == F.col("lang"))


def review_pool(spark: SparkSession, sf: str) -> DataFrame:
    """20 of the first 500 documents, without blank ones; fails if there are not as many."""
    pool = sampling.pool_sample(documents(spark, sf), "doc_id", 500, 20, T.strip(F.col("text")) != "")
    return sampling.require_rows(pool, 20, "fewer than 20 texts in the pool")


def langid_review_sample(spark, sf):
    pool = review_pool(spark, sf)
    found = L.identify(pool, language_model(spark, sf))
    return pool.join(F.broadcast(found), "doc_id").select("doc_id", "rank", "label", "score", T.excerpt(F.col("text")).alias("excerpt"))


# -- classifiers -------------------------------------------------------------------------------------------


def train_quality_nb(spark, sf):
    model = C.train(labelled(spark, sf).drop("toxic"), (C.QUALITY,), C.WORD_NAMES)
    counts = [(c, C.QUALITY.count(i)) for i, c in enumerate(C.QUALITY.classes)]
    rows = F.array(*[F.struct(F.lit(c).alias("label"), F.col(n).alias("n")) for c, n in counts])
    return model.select("feature", F.inline(rows))


def _scores(head: C.Head) -> Query:
    def query(spark, sf):
        model = C.train(labelled(spark, sf), (head,), C.WORDS)
        found = C.scores(documents(spark, sf), model, (head,), C.WORDS)
        return found.select("doc_id", F.col(f"{head.label}_label").alias("label"), F.col(f"{head.label}_score").alias("score"))

    return query


def confident_clean(spark, sf):
    found = _scores(C.TOXIC)(spark, sf)
    return found.where(Q.is_confidently_clean(F.col("label"), F.col("score"), "toxic"))


def train_quality_lr(spark, sf):
    model = train_softmax(labelled(spark, sf), "quality", C.QUALITY.classes)
    return softmax_scores(documents(spark, sf), model)


def build_stats(spark, sf):
    return Q.build_statistics(examples(spark, sf))


def responses(spark: SparkSession, sf: str) -> DataFrame:
    """``(doc_id, label, status, content_type, body)``: the pages as a crawl would deliver them, with every kind of failure.

    Of twenty consecutive pages one each is not found, fails, lacks HTTP headers, is a PDF, declares a charset that is none, and
    has no body text.
    """
    kind = F.col("page_id") % 20
    status = F.when(kind == 0, "404 Not Found").when(kind == 1, "500 Failure").otherwise("200 OK")
    sent = F.when(kind == 3, "application/pdf").otherwise("Text/HTML; charset=utf-8")
    head = F.when(kind == 2, "").otherwise(F.concat(F.lit("HTTP/1.1 "), status, F.lit("\r\nContent-Type: "), sent, F.lit("\r\n\r\n")))
    page = F.when(kind == 5, F.lit("<html><body> </body></html>")).otherwise(F.col("html"))
    body = F.when(kind == 4, F.concat(F.encode(F.lit("<meta charset=hex>"), "UTF-8"), F.unhex(F.lit("FF")))).otherwise(F.encode(page, "UTF-8"))
    label = F.when(F.col("page_id") % 2 == 0, Q.POSITIVE).otherwise(Q.NEGATIVE)
    records = pages(spark, sf).select(
        F.col("page_id").alias("doc_id"), label.alias("label"), F.concat(F.encode(head, "UTF-8"), body).alias("payload")
    )
    return warc.with_http_fields(records)


def response_examples(spark: SparkSession, sf: str) -> DataFrame:
    harm = C.train(labelled(spark, sf).drop("quality"), (C.TOXIC,), C.WORDS)
    found, _ = Q.examples_of_responses(responses(spark, sf), language_model(spark, sf), harm, (C.TOXIC,), "doc_id")
    return found


def response_stats(spark, sf):
    return Q.build_statistics(response_examples(spark, sf))


def response_quarantine(spark, sf):
    """The responses that are not used, each with its reason, and whether reading it failed."""
    bad = Q.quarantine(Q.responses_to_texts(responses(spark, sf)), "label").bad
    return bad.select("doc_id", "label", "reason", F.col("error").isNotNull().alias("failed"))


def build_set_from_responses(spark, sf):
    return Q.build_set(response_examples(spark, sf))


def incremental_report(spark, sf):
    """The report of a stream over the documents in several micro-batches, one of them run again."""
    source, output = scratch_path(spark, "stream-in"), scratch_path(spark, "stream-out")
    read_table(spark, sf, "documents", ["doc_id", "text", "source"]).repartition(6, "doc_id").write.parquet(source)
    trained = models(spark, sf)
    for attempt in ("first", "again"):  # a new checkpoint sees all files again, as after a lost one
        curate_incrementally(spark, source, output, f"{output}/checkpoint-{attempt}", trained, files_per_batch=2, input_format="parquet")
    return streamed_report(spark, output)


def balanced_set(spark, sf):
    usable = examples(spark, sf).where("reason is null").select("doc_id", "label")
    return sampling.balance_classes(usable, "doc_id", "label", (Q.POSITIVE, Q.NEGATIVE))


def train_valid_split(spark, sf):
    """The split alone: every labelled document, balanced by its raw label."""
    labels = read_table(spark, sf, "labels", ["doc_id", "quality"])
    named = C.with_named_labels(labels, {"quality": LABEL_NAMES["quality"]}).withColumnRenamed("quality", "label")
    return Q.build_set(named.withColumn("reason", F.lit(None).cast("string")))


def build_quality_set(spark, sf):
    return Q.build_set(examples(spark, sf))


def labelled_lines(spark, sf):
    return Q.labelled_lines(build_quality_set(spark, sf), documents(spark, sf))


def quality_eval(spark, sf):
    # read twice while training and evaluating; at most twice the cap of rows
    return Q.train_and_evaluate(materialize(build_quality_set(spark, sf)), documents(spark, sf))


# -- samples -----------------------------------------------------------------------------------------------


def sample_kept(spark, sf):
    kept = P.judge(documents(spark, sf), models(spark, sf)).where("reason is null")
    return sampling.require_rows(sampling.seeded_sample(kept, "doc_id", 5).select("doc_id", "rank"), 5, "fewer than 5 kept documents")


def sample_rejected(spark, sf):
    """100 random candidates are judged, and the first five rejected ones shown."""
    candidates = sampling.seeded_sample(documents(spark, sf), "doc_id", 100).drop("rank")
    refused = P.judge(candidates, models(spark, sf)).where("reason is not null").select("doc_id", "reason")
    sample = sampling.seeded_sample(refused, "doc_id", 5, seed=sampling.SEED + 1)
    return sampling.require_rows(sample, 5, "fewer than 5 rejected documents among the candidates")


def quality_review_sample(spark, sf):
    pool = review_pool(spark, sf)
    return rules.with_rule_measures(pool).select("doc_id", "rank", rules.failed_rule().isNull().alias("passed"))


def harm_review_sample(spark, sf):
    pool = review_pool(spark, sf)
    model = C.train(labelled(spark, sf), (C.TOXIC,), C.WORDS)
    found = C.scores(pool, model, (C.TOXIC,), C.WORDS)
    return pool.select("doc_id", "rank").join(found, "doc_id").select(
        "doc_id", "rank", F.col("toxic_label").alias("verdict"), F.col("toxic_score").alias("score")
    )


# -- tokens ------------------------------------------------------------------------------------------------


def _tokenized(spark, sf):
    docs = documents(spark, sf)
    return K.tokenize(docs, K.build_vocabulary(docs))


def tokenize_docs(spark, sf):
    return _tokenized(spark, sf).select(
        "doc_id",
        F.size("tokens").alias("n_tokens"),
        F.md5(F.array_join(F.col("tokens").cast("array<string>"), " ")).alias("token_hash"),
    )


def detokenize_docs(spark, sf):
    docs = documents(spark, sf)
    vocabulary = materialize(K.build_vocabulary(docs))
    return K.detokenize(K.tokenize(docs, vocabulary), vocabulary)


def token_offsets(spark, sf):
    lengths = _tokenized(spark, sf).select("doc_id", F.size("tokens").alias("n_tokens"))
    return K.token_offsets(lengths, ["doc_id"]).select("doc_id", "offset")


def token_report(spark, sf):
    return K.token_report(_tokenized(spark, sf))


def pack_sequences(spark, sf):
    return sequences.corpus_to_sequences(documents(spark, sf), ["doc_id"])


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        word_count, ws_normalize, normalize_text, length_filter, pii_mask_all, pii_hits, quality_rules,
        quality_filter, rejection_reason, filter_report, filter_report_by_source, filter_funnel, baseline_vs_final,
        curate_documents, exact_line_dedup, exact_doc_dedup, exact_dedup_report, ngram_counts, minhash_signature,
        lsh_candidates, lsh_buckets, jaccard_pairs, dup_clusters, fuzzy_dedup, html_extract, extract_compare, zip_mismatches, url_domain, url_domain_rules,
        valid_urls, url_extract, url_sample, manifest_chunks, lang_id, english_filter, english_text_share,
        langid_confusion, threshold_curve, langid_review_sample, train_quality_nb, confident_clean, quality_eval,
        train_quality_lr, build_quality_set, build_stats, response_stats, response_quarantine, build_set_from_responses,
        incremental_report, balanced_set, train_valid_split, labelled_lines,
        sample_kept, sample_rejected, quality_review_sample, harm_review_sample, tokenize_docs, detokenize_docs, token_offsets,
        token_report, pack_sequences,
    )
} | {
    "mask_emails": _masked_by(pii.mask_emails),
    "mask_phones": _masked_by(pii.mask_phones),
    "mask_ips": _masked_by(pii.mask_ips),
    "quality_score": _scores(C.QUALITY),
    "toxicity_score": _scores(C.TOXIC),
}
