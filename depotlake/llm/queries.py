"""One query per operator over the given tables, with the parameters a production run would use."""

from __future__ import annotations

import zlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from depotlake.config import scratch_dir
from depotlake.llm import chat, decontam, grammar, jaccard, langid, licences, packing, quality, reshard, runs, secrets, spelling, warc
from depotlake.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def tokenizer_path(name: str) -> str:
    """A public vocabulary file; it lies at the same place on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_hilbert_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def op2_grammar_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch_dir(spark, "grammar")
    grammar.write_grammar(table(spark, sf_dir, "documents"), folder, tokenizer_path("word_bpe_49k.json"))
    read = grammar.read_grammar(spark, folder)
    return read.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"), "shard")


def op3_flow_resharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From six shards by source, which are as uneven as the sources, to eight of equal bytes."""
    old = F.pmod(F.crc32(F.col("source").cast("binary")), F.lit(6))
    layout = reshard.reshard(table(spark, sf_dir, "documents"), old, old_shards=6, new_shards=8)
    return layout.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "old_shard",
        "moved",
    )


def op4_prefix_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return jaccard.near_duplicates(documents, jaccard.Rule(size=3, percent=90))


def op5_risk_controlled_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    measured = quality.measure(table(spark, sf_dir, "documents"))
    return quality.judge(measured, table(spark, sf_dir, "labels")).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
        "stratum",
        "level",
        "certified",
    )


def op6_licence_paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = licences.scan(documents, licences.fit(documents), carry=["doc_id"])
    sure = F.filter("findings", lambda f: f["confirmed"])
    return found.select(
        "row.doc_id",
        "n_paragraphs",
        F.size("findings").cast("long").alias("n_predicted"),
        F.size(sure).cast("long").alias("n_confirmed"),
        F.array_join(F.array_sort(F.array_distinct(F.transform(sure, lambda f: f["family"]))), ",").alias("families"),
        F.array_join(F.transform(sure, lambda f: f["paragraph"].cast("string")), ",").alias("paragraphs"),
    )


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    scanned = decontam.scan(documents, table(spark, sf_dir, "benchmark"), carry=["doc_id"])
    return scanned.select(
        "row.doc_id",
        "hit.n_words",
        "hit.n_hit",
        F.size("hit.items").cast("long").alias("n_items"),
        F.sha2(F.array_join("hit.items", ","), 256).alias("items_sha256"),
        decontam.contaminated().alias("contaminated"),
    )


def op8_secret_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    forest = secrets.train(secrets.example_findings(spark))
    scanned = secrets.scan(table(spark, sf_dir, "documents").select("doc_id", "text"), forest)
    return scanned.select(
        "row.doc_id",
        F.size("found").cast("long").alias("n_candidates"),
        F.size("secrets").cast("long").alias("n_secrets"),
        F.sha2(F.array_join(F.transform("secrets", lambda s: s["token"]), "\n"), 256).alias("secrets_sha256"),
        F.crc32(F.coalesce("redacted", F.lit("")).cast("binary")).alias("redacted_crc32"),
    )


def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    says = "</s>[INST] ok [/INST]"
    messages = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    control = spark.sql(
        "SELECT -7L AS conv_id, turn, role, :says AS text FROM VALUES (0L, 'user'), (1L, 'assistant') AS t(turn, role)",
        args={"says": says},
    )
    parsed = chat.read_back(chat.format_conversations(messages.union(control)))
    turns = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return parsed.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(turns, ""), 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2("loss_text", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
        "valid",
    )


def _identified(found: DataFrame, key: str) -> DataFrame:
    return found.select(
        f"row.{key}",
        "language",
        F.round("posterior", 6).alias("posterior"),
        "text_language",
        (~F.col("junk")).alias("kept"),
    )


def op10_language_evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A document's source is its host, its lang column what its markup declares."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    return _identified(langid.identify(documents, F.col("lang"), host=F.col("source"), carry=["doc_id"]), "doc_id")


def pages_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same operator where all evidence is at hand: the page's lang attribute and its address."""
    plain = F.regexp_replace("html", r"(?s)<(script|style)\b.*?</\1>|<[^>]*>", " ")
    declared = F.regexp_extract("html", r"(?i)<html[^>]*\blang\s*=\s*[\"']?([A-Za-z]+)", 1)
    pages = table(spark, sf_dir, "pages").select("page_id", "url", plain.alias("text"), declared.alias("declared"))
    where = langid.address(F.col("url"))
    return _identified(langid.identify(pages, F.col("declared"), **where, carry=["page_id"]), "page_id")


def op11_warc_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sizes and digests of responses are those of the payloads as read, those of revisits come from their headers."""
    found = warc.archive_pages(table(spark, sf_dir, "pages"), scratch_dir(spark, "warc"))
    whole = F.col("record_type") == "response"
    return found.select(
        warc.page_id(F.col("record_id")).alias("page_id"),
        F.when(whole, F.octet_length("payload").cast("long")).otherwise(F.col("payload_length")).alias("payload_bytes"),
        F.when(whole, F.sha1("payload")).otherwise(F.col("payload_digest")).alias("payload_digest"),
        "record_type",
        warc.page_id(F.col("refers_to")).alias("refers_to"),
    )


def periodic_words(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The words with a periodic tail in every tenth document: from a place on, a first part comes again and again."""
    h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h % 10 or not words:
        return words
    g, n = h // 10, len(words)
    start = g % n
    period = 1 + (n - start) // (3 + g % 8)
    return words[:start] + [words[start + k % period] for k in range(n - start)]


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = runs.scan(documents, periodic_words, carry=["doc_id"]).withColumn("best", runs.best_run(F.col("runs")))
    line = lambda r: F.concat_ws(",", r["start"], r["length"], F.concat(r["period"].cast("string"), F.lit("\n")))
    lines = F.array_join(F.transform("runs", line), "")
    return found.select(
        "row.doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.expr("best.length * 1000 div best.period").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def misspelt(doc_id: int | None, word: str) -> str:
    """The word, in one of 31 cases without one of its code points."""
    if doc_id is None:
        return word
    h = zlib.crc32(f"{doc_id}:{word}".encode())
    if h % 31:
        return word
    at = h % len(word)
    return word[:at] + word[at + 1 :]


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return spelling.variants(documents, edit=misspelt).select("word", "form", "root", "n", "n_near", "form_n")


QUERIES: dict[str, Query] = {
    "op1_hilbert_packing": op1_hilbert_packing,
    "op2_grammar_tokens": op2_grammar_tokens,
    "op3_flow_resharding": op3_flow_resharding,
    "op4_prefix_join": op4_prefix_join,
    "op5_risk_controlled_rules": op5_risk_controlled_rules,
    "op6_licence_paragraphs": op6_licence_paragraphs,
    "op7_decontamination": op7_decontamination,
    "op8_secret_forest": op8_secret_forest,
    "op9_chat_format": op9_chat_format,
    "op10_language_evidence": op10_language_evidence,
    "op11_warc_source": op11_warc_source,
    "op12_periodic_runs": op12_periodic_runs,
    "op13_spelling_variants": op13_spelling_variants,
    "pages_language": pages_language,
}
