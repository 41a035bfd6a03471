"""The registered queries of this subpackage and their check SQL."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from flowlens.llm import (bloom_lm, chunks, covertree, grammar, mixing, packing, phrases, quality, rollups, runs, setsketch, toxicity,
                          warc)
from flowlens.llm.common import words_of
from flowlens.session import new_path, stage

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def vocabulary(name: str) -> str:
    """Place of a public vocabulary file: the folder TOKENIZER_FILES, or that of the installed package."""
    folder = os.environ.get("TOKENIZER_FILES")
    if folder:
        return os.path.join(folder, name)
    import public_tokenizers

    return public_tokenizers.path(name)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_chunk_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact copies of documents, by recipes of chunks."""
    return chunks.dedup(_table(spark, sf_dir, "documents")).drop("n_chunks")


def op2_repair_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of all documents, written to grammar-compressed shards and read back."""
    return grammar.encode_documents(_table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into windows of 4096 tokens."""
    return packing.pack(_table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))


def op4_adaptive_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality verdicts by thresholds of language and source."""
    return quality.verdicts(_table(spark, sf_dir, "documents"))


def op5_pu_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity scores of all documents."""
    docs = _table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, _table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).select(
        "doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score",
        F.when(F.col("score") >= 0.7, 1).otherwise(0).alias("predicted"))


def op6_warc_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages, written to archives and read back."""
    return warc.read_archives(warc.write_archives(_table(spark, sf_dir, "pages"))).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op7_bloom_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log10 probabilities of all documents."""
    docs = _table(spark, sf_dir, "documents")
    return bloom_lm.score(docs, bloom_lm.fit(docs))


PIECES = {"pieces-1": r"[A-Za-z0-9]+|[^A-Za-z0-9\x20\x09-\x0D]+", "pieces-2": r"[A-Za-z]+|[0-9]|[^A-Za-z0-9\x20\x09-\x0D]"}


def op8_token_rollups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals after four batches over all documents and one that is sent again.

    All are inserted with words and pieces counted by a first tokenizer version; the pieces of all are revised to
    a second version; texts under 10 words are deleted.
    """
    docs = _table(spark, sf_dir, "documents")
    text = F.coalesce("text", F.lit(""))
    counted = stage(docs.select("source", "lang", mixing.sized(docs).alias("words"),
                                *[F.regexp_count(text, F.lit(p)).cast("long").alias(n) for n, p in PIECES.items()]), "counts")

    def changes(op: str, rows: DataFrame, new: tuple[str, str] | None, old: tuple[str, str] | None) -> DataFrame:
        def side(prefix: str, of: tuple[str, str] | None) -> list:
            version, column = of or (None, None)
            return [F.col("source").alias(f"{prefix}source"), F.col("lang").alias(f"{prefix}lang"),
                    F.lit(version).cast("string").alias(f"{prefix}tokenizer"),
                    (F.col(column) if column else F.lit(None).cast("long")).alias("old_tokens" if prefix else "n_tokens")]
        return rows.select(F.lit(op).alias("op"), *side("", new), *side("old_", old))

    words, first, second = ("words-1", "words"), ("pieces-1", "pieces-1"), ("pieces-2", "pieces-2")
    short = counted.where("words < 10")
    totals = rollups.Rollup(spark, new_path(spark, "rollup"))
    load = changes("insert", counted, words, None).unionAll(changes("insert", counted, first, None))
    totals.commit("load", load)
    totals.commit("revise", changes("revise", counted, second, first))
    totals.compact()
    totals.commit("delete", changes("delete", short, None, words).unionAll(changes("delete", short, None, second)))
    totals.commit("load", load)
    return totals.totals()


def op9_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the mix takes of each document."""
    return mixing.plan(_table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken", "n_copies")


def op10_setsketch_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents with similar sets of three-word shingles."""
    return setsketch.near_duplicates(_table(spark, sf_dir, "documents"), width=3, percent=85)


def op11_cover_tree_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth vector; every seventh has another label."""
    vectors = _table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return covertree.hard_negatives(vectors, F.col("vec_id") % 100 == 0, label=label)


def op12_phrase_automata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without the words that passages of documents with smaller ids cover."""
    found = phrases.drop_repeats(_table(spark, sf_dir, "documents"))
    covered = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select("doc_id", "n_words", covered.alias("n_removed"), F.sha2("kept_text", 256).alias("kept_sha256"))


def op13_maximal_pair_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Periodic runs of words, in documents of which a tenth are made periodic from some word on."""
    hashed = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", words_of(F.coalesce("text", F.lit(""))).alias("w"), hashed.alias("h")) \
        .select("*", F.size("w").alias("n"), F.floor(F.col("h") / 10).alias("g")) \
        .select("*", F.expr("cast(if(h % 10 = 0 and n > 0, g % n, 0) as int)").alias("a")) \
        .select("*", F.expr("cast(1 + floor((n - a) / (3 + g % 8)) as int)").alias("p"))
    # The words before a, then the p words from there again and again.
    made = F.expr("array_join(concat(slice(w, 1, a), slice(flatten(array_repeat(slice(w, a + 1, p), "
                  "cast(ceil((n - a) / p) as int))), 1, n - a)), ' ')")
    planted = docs.select("doc_id", F.when((F.col("h") % 10 == 0) & (F.col("n") > 0), made).otherwise(F.col("text")).alias("text"))
    found = runs.periodic_runs(planted)
    longest = F.array_max(F.transform("runs", lambda r: F.struct(
        r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    lines = F.array_join(F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])), "\n")
    return found.withColumn("best", longest).select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("best.start")).alias("start"), F.col("best.length").alias("length"),
        (-F.col("best.period")).alias("period"), F.expr("(1000 * best.length) div -best.period").alias("exponent_milli"),
        F.sha2(F.when(F.size("runs") > 0, F.concat(lines, F.lit("\n"))).otherwise(""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    op1_chunk_dedup, op2_repair_tokens, op3_best_fit_packing, op4_adaptive_quality, op5_pu_toxicity, op6_warc_archives,
    op7_bloom_lm, op8_token_rollups, op9_source_mix, op10_setsketch_near_dedup, op11_cover_tree_negatives, op12_phrase_automata,
    op13_maximal_pair_runs)}

# Words, lines and their counts of a text, for the check SQL.
_COUNTED = rf"""
words as (select doc_id, lang, source, coalesce(text, '') as t, {WORDS} as w from documents),
grams as (select doc_id, unnest(range(1, len(w) - 3)) as i, w from words where len(w) >= 5),
marked as (select doc_id, i, count(*) over (partition by doc_id, w[i], w[i + 1], w[i + 2], w[i + 3], w[i + 4]) as n from grams),
again as (select doc_id, count(distinct i + j) as n from marked, (select unnest(range(5)) as j) where marked.n > 1 group by doc_id),
lines as (select *, [x for x in string_split(t, chr(10)) if regexp_matches(x, '[^\x20\x09-\x0D]')] as l from words),
measured as (
  select doc_id, lang, source, len(w) as n_words, length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) as word_chars,
         length(t) - length(translate(t, '#*$%&|<>', '')) as n_symbols, len(l) as n_lines,
         len(l) - len(list_distinct(l)) as n_dup_lines, coalesce(again.n, 0) as n_repeat_words
  from lines left join again using (doc_id)),
judged as (select *, n_words < {quality.LEAST_WORDS} or 100 * n_repeat_words > {quality.MOST_REPEAT_PERCENT} * n_words as base_failed
           from measured)"""


def _quality_sql() -> str:
    ratios = {name: f"{above}::double / greatest({below}, 1)" for name, (above, below) in quality.RATIOS.items()}
    values = " union all ".join(f"select lang, source, '{n}' as ratio, {v} as value, {quality.SPREAD[n]} as spread from passed" for n, v in ratios.items())
    quartiles = ", ".join(f"min(case when 4 * upto >= {k} * docs then value end) as q{k}" for k in (1, 3))

    def level(name: str, keys: str) -> str:
        by = f"{keys}, " if keys else ""
        return f"""{name}_b as (select {by}ratio, spread, bucket, sum(n) as n from sketch group by all),
{name}_r as (select {by}ratio, spread, case when bucket is null then 0 else 2 * pow({quality.GAMMA}, bucket) / ({quality.GAMMA} + 1) end as value,
  sum(n) over (partition by {by}ratio order by bucket nulls first) as upto, sum(n) over (partition by {by}ratio) as docs from {name}_b),
{name} as (select {by}ratio, spread, max(docs) as docs, {quartiles} from {name}_r group by all)"""

    def pick(q: str) -> str:
        return (f"case when own.docs >= {quality.LEAST_DOCS} then own.{q} when of_lang.docs >= {quality.LEAST_DOCS} then of_lang.{q} "
                f"else of_all.{q} end")

    beyond = " or ".join([f"coalesce({v} > (select high from limits m where m.ratio = '{n}' and m.lang is not distinct from j.lang "
                          f"and m.source is not distinct from j.source), false)" for n, v in ratios.items()]
                         + [f"coalesce({ratios[n]} < (select low from limits m where m.ratio = '{n}' and m.lang is not distinct from j.lang "
                            f"and m.source is not distinct from j.source), false)" for n in quality.BELOW])
    return f"""with {_COUNTED}, passed as (select * from judged where not base_failed), vals as ({values}),
sketch as (select lang, source, ratio, spread, case when value > 0 then ceil(ln(value) / ln({quality.GAMMA})) end as bucket, count(*) as n
  from vals group by all),
{level("own", "lang, source")}, {level("of_lang", "lang")}, {level("of_all", "")},
chosen as (select own.lang, own.source, own.ratio, own.spread, {pick("q1")} as q1, {pick("q3")} as q3 from own
  join of_lang on own.lang is not distinct from of_lang.lang and own.ratio = of_lang.ratio join of_all on own.ratio = of_all.ratio),
limits as (select lang, source, ratio, q3 + {quality.FENCE} * greatest(q3 - q1, spread) as high,
  q1 - {quality.FENCE} * greatest(q3 - q1, spread) as low from chosen)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, not base_failed and not ({beyond}) as kept
from judged j"""


# Base32 of a SHA-1: its 160 bits in 32 groups of five.
_BASE32 = "list_aggregate([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + " + " + ".join(
    f"{16 >> k} * cast(substr(bits, (5 * i + {k + 1})::int, 1) as int)" for k in range(5)) + ", 1) for i in range(32)], 'string_agg', '')"

ORACLES: dict[str, str] = {
    "op1_chunk_dedup": f"""
select doc_id, max(doc_id) over (partition by t) as keep_id, count(*) over (partition by t) as group_size,
       doc_id = max(doc_id) over (partition by t) as kept, sha256(t) as text_sha256
from (select doc_id, {LOWER} as t from documents)""",
    "op4_adaptive_quality": _quality_sql(),
    "op6_warc_archives": f"""
select page_id, payload_bytes, {_BASE32} as payload_digest, case when page_id = first_id then 'response' else 'revisit' end as record_type,
       case when page_id <> first_id then first_id end as refers_to
from (select page_id, strlen(h) as payload_bytes, cast(cast(unhex(sha1(h)) as bit) as varchar) as bits,
             min(page_id) over (partition by h) as first_id
      from (select page_id, coalesce(html, '') as h from pages))""",
    "op8_token_rollups": rf"""
with counted as (select source, lang, len({WORDS}) as words,
  len(regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[0-9]|[^A-Za-z0-9\x20\x09-\x0D]')) as pieces from documents)
select source, lang, v.tokenizer, count(*) as n_docs, cast(sum(case when v.tokenizer = 'words-1' then words else pieces end) as bigint) as n_tokens
from counted, (values ('words-1'), ('pieces-2')) v(tokenizer) where words >= 10 group by all""",
    "op9_source_mix": f"""
with recursive sized as (select doc_id, source, len({WORDS}) as size from documents),
per as (select source, sum(size)::double as source_size, (row_number() over (order by source nulls last) - 1) % {mixing.CYCLE} + 1 as weight
        from sized group by source),
ordered as (select *, {mixing.MOST_REPEATS} * source_size as cap,
  row_number() over (order by {mixing.MOST_REPEATS} * source_size / weight, source nulls last) as k from per),
before as (select a.k, a.cap, a.weight, (select sum(source_size) from per) - coalesce(sum(b.cap), 0) as rest,
  (select sum(weight) from per) - coalesce(sum(b.weight), 0) as weights from ordered a left join ordered b on b.k < a.k group by all),
level as (select rest / weights as level from before where cap > rest / weights * weight order by k limit 1),
rated as (select source, source_size, coalesce(least(cap, (select level from level) * weight), cap) as target from ordered),
joined as (select s.doc_id, s.size, r.source_size, r.target, case when r.source_size > 0 then r.target / r.source_size else 0 end as rate,
  ('0x' || substr(md5('{mixing.SEED}/' || s.doc_id), 1, 13))::bigint / {16 ** 13}.0::double as draw
  from sized s join rated r on s.source is not distinct from r.source),
copied as (select *, cast(floor(rate) + case when draw < rate - floor(rate) then 1 else 0 end as bigint) as n_copies from joined)
select doc_id, size, cast(source_size as bigint) as source_size, target, n_copies * size as taken, n_copies from copied""",
    "op11_cover_tree_negatives": """
with vectors as (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
         [cast(floor(256 * cast(x as double)) as bigint) for x in embedding] as v
  from embeddings where vec_id is not null and label is not null and embedding is not null
    and len([x for x in embedding if x is null or not isfinite(x)]) = 0),
scored as (
  select a.vec_id as anchor_id, a.label as anchor_label, b.vec_id, b.label,
         cast(list_sum([p[1] * p[2] for p in [[x, b.v[i]] for x, i in a.v]]) as bigint) as score
  from vectors a, vectors b where a.vec_id % 100 = 0),
positives as (
  select anchor_id, anchor_label, vec_id as positive_id, score as positive_score from scored
  where label = anchor_label and vec_id <> anchor_id
  qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5),
fitting as (
  select p.anchor_id, p.positive_id, p.positive_score, s.vec_id as negative_id, s.score as negative_score,
         row_number() over (partition by p.anchor_id, p.positive_id order by s.score desc, s.vec_id) as rank
  from positives p join scored s on s.anchor_id = p.anchor_id and s.label <> p.anchor_label
   and 30 * p.positive_score <= 100 * s.score and 100 * s.score <= 90 * p.positive_score)
select anchor_id, positive_id, cast(rank as int) as rank, negative_id, positive_score, negative_score from fitting where rank <= 10""",
}
