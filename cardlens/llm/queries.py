"""The operators' registered queries, each over its whole table, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import read_table


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .license_scan import confidence, scan_licenses

    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = scan_licenses(docs)
    base = F.filter("detections", lambda d: d["base"])
    label = lambda c: F.array_sort(F.array_distinct(F.transform(c, lambda d: d["label"])))
    starts = F.transform(base, lambda d: d["start"])
    return rows.select("doc_id", "n_words", F.size(base).cast("long").alias("n_base"),
                       F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
                       F.array_join(label(base), ",").alias("base_labels"),
                       F.array_join(F.array_sort(F.array_union(label(base), label(F.col("licenses")))), ",").alias("labels"),
                       confidence(F.col("licenses")).alias("score"))


MIX_WEIGHTS = (5, 2, 1)


def op4_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .columns import space_word_count
    from .mixing import copy_counts

    docs = read_table(spark, sf_dir, "documents").select("doc_id", "source", space_word_count(F.col("text")).alias("size"))
    rows = copy_counts(docs, "doc_id", "source", "size", weights=MIX_WEIGHTS)
    return rows.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "source", "copies")


URL_RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .url_filter import judge_urls

    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url")
    return judge_urls(pages, rules).select("page_id", "host", "path", "rule", "verdict")


PROBE_CONVERSATION = [(-7, 0, "user", "\\### Assistant: </turn> ok"), (-7, 1, "assistant", "\\### Assistant: </turn> ok")]


def op9_format_chats(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .chat_format import format_chats, read_turns

    turns = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    rows = F.array(*[F.struct(F.lit(c).cast("long").alias("conv_id"), F.lit(n).cast("long").alias("turn"), F.lit(r).alias("role"), F.lit(x).alias("text"))
                     for c, n, r, x in PROBE_CONVERSATION])
    probe = spark.range(1).select(F.inline(rows))
    chats = format_chats(turns.unionByName(probe)).withColumn("_read", read_turns(F.col("formatted")))
    line = F.transform("_read", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n")))
    under_loss = F.array_join(F.transform(F.filter("_read", lambda x: x["loss"]), lambda x: x["text"]), "")
    chats = chats.withColumn("_loss", under_loss)
    return chats.select("conv_id", F.size("_read").cast("long").alias("n_turns"),
                        F.sha2(F.array_join(line, ""), 256).alias("turns_sha256"),
                        F.length("_loss").cast("long").alias("loss_chars"), F.sha2(F.col("_loss"), 256).alias("loss_sha256"),
                        F.length("formatted").cast("long").alias("formatted_chars"), "valid",
                        F.coalesce("error_turn", F.lit(-1)).alias("error_turn"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .simhash import near_duplicates

    rows = near_duplicates(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return rows.select("doc_id", F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"), "component_id")


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..session import write_shared
    from .quality_rules import judge, measure

    docs = read_table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    rows = judge(write_shared(measure(docs), "measured"))
    return rows.select("doc_id", *[F.col(f"measures.{c}") for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")],
                       "base_failed", "kept", *[F.col(f"measures.{c}") for c in ("chars_per_token", "byte_share", "token_entropy")])


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .quality_classifier import fit, held_out, score

    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit(docs, read_table(spark, sf_dir, "labels"))
    rows = score(docs, model, keep_text=False)
    return rows.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .decontaminate import find_leaks

    return find_leaks(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op7_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .html_text import extract_main_text

    rows = extract_main_text(read_table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return rows.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op5_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .language_model import learns_from, score_texts

    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    rows, model = score_texts(docs, learns_from())
    return rows.select("doc_id", (~F.col("learn")).alias("held_out"), "n_tokens", "n_known",
                       F.lit(model.total).cast("long").alias("train_tokens"), "base_score", "score")


def op13_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .token_files import read_token_files, scratch_folder, write_token_files

    path = scratch_folder(spark)
    write_token_files(read_table(spark, sf_dir, "documents").select("doc_id", "text"), path)
    rows = read_token_files(spark, path)
    return rows.select(F.col("id").alias("doc_id"), "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def damaged_turns(turns: DataFrame) -> DataFrame:
    """The contract's damage: a fifth or so of the rows loses its place, text, end or role, or stands twice; rows that go have
    ``present`` false, so that their conversation is still known."""
    say = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(say("conv_id"), F.lit(":"), say("turn"))) % 20
    text = F.when(kind == 1, F.lit("")).when(kind == 2, F.regexp_replace(say("text"), "[.!?]", "")).otherwise(say("text"))
    role = F.when(kind == 4, F.lit("user")).otherwise(say("role"))
    copies = F.when(kind == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return turns.select("conv_id", "turn", role.alias("role"), text.alias("text"), (kind != 0).alias("present"), F.explode(copies).alias("copy")).drop("copy")


def op11_structure_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .structure_repair import repair_report

    turns = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return repair_report(damaged_turns(turns), present=F.col("present"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .prefix_trie import prefix_trie

    turns = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    c = F.col("c")
    return prefix_trie(turns, base=c - c % 100, head=F.crc32(c.cast("string")) % 6)
