"""Registered queries on documents and their SQL counterparts."""

from __future__ import annotations

import secrets

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from brindle.llm import collocations, exact, licenses, line_rules, negatives, ngram_join, packing, pieces, pii, ppm, quality, token_counts, toxicity
from brindle.llm.texts import small_batches
from brindle.session import spread

PIECES = public_tokenizers.path("piece_bpe_32k.model")
WORDS = public_tokenizers.path("word_bpe_49k.json")
PII_KEY = "spark.brindle.piiKey"
_own_keys: dict[str, str] = {}


def pii_key(spark: SparkSession) -> str:
    """The key of the pseudonyms, from the setting `spark.brindle.piiKey`.

    Without the setting the application draws one of its own: its pseudonyms agree with each other,
    and nobody can invert them.
    """
    key = spark.conf.get(PII_KEY, None)
    return key or _own_keys.setdefault(spark.sparkContext.applicationId, secrets.token_hex(32))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return spread(spark.read.parquet(f"{sf_dir}/documents.parquet"))


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.ngram_links(documents(spark, sf_dir))


def op2_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(documents(spark, sf_dir))


def _canonical_sql(text: str) -> str:
    """SQL for the canonical lines of a text: holders' lines are emptied one by one, line breaks stay."""
    holder = licenses.HOLDER.replace("'", "''")
    sql = f"replace(replace(lower(coalesce({text}, '')), chr(13) || chr(10), chr(10)), chr(13), chr(10))"
    lines = f"[case when regexp_matches(line, '^(?:{holder})') then '' else line end for line in string_split({sql}, chr(10))]"
    sql = f"regexp_replace(chr(10) || array_to_string({lines}, chr(10)), '{licenses.NO_WORD}', ' ', 'g')"
    for spelling, standard in licenses.SPELLINGS:
        sql = f"replace({sql}, '{spelling}', '{standard}')"
    return sql


def _digest_sql(canonical: str) -> str:
    return f"sha256(trim(regexp_replace({canonical}, '[ \n]+', ' ', 'g')))"


_KNOWN_SQL = ", ".join("({}, {})".format(*("'" + v.replace("'", "''") + "'" for v in row)) for row in licenses.KNOWN)
OP2_SQL = f"""
with known as (
    select {_digest_sql(_canonical_sql("t"))} as digest, min(id) as license_id
    from (values {_KNOWN_SQL}) as k(id, t) group by 1
), docs as (select row_number() over () as row, doc_id, {_canonical_sql("text")} as lines from documents),
parts as (select row, unnest(string_split(lines, chr(10))) as line from docs),
found as (
    select row, string_agg(distinct license_id, ',' order by license_id) as line_licenses
    from parts join known on {_digest_sql("line")} = known.digest group by row
)
select doc_id, {_digest_sql("lines")} as text_digest, known.license_id,
       coalesce(line_licenses, '') as line_licenses
from docs left join known on {_digest_sql("lines")} = known.digest left join found using (row)
"""


def op3_ppm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ppm.score_texts(documents(spark, sf_dir))


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_groups(documents(spark, sf_dir))


OP4_SQL = """
select doc_id, max(doc_id) over same as keep_id, count(*) over same as group_size,
       doc_id = max(doc_id) over same as kept, sha256(coalesce(text, '')) as text_sha256
from documents window same as (partition by coalesce(text, ''))
"""


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pseudonymize(documents(spark, sf_dir).select("doc_id", "text"), pii_key(spark))


def op6_line_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    return line_rules.rate_documents(docs, line_rules.fit_lines(docs, labels(spark, sf_dir)))


def op7_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sampled pieces of every text, and whether decoding gives the text back (by its SHA-256, so that
    the text itself does not have to pass the decoder)."""
    encoded = pieces.encode_sampled(documents(spark, sf_dir), PIECES)
    digested = encoded.select("doc_id", "pieces", F.unhex(F.sha2("text", 256)).alias("digest"))
    rows = pieces.decode(digested, PIECES)
    return rows.select(
        "doc_id",
        F.coalesce(F.size("pieces"), F.lit(0)).cast("long").alias("n_pieces"),
        F.xxhash64("pieces").alias("pieces_hash"),
        F.unhex(F.sha2("decoded", 256)).eqNullSafe(F.col("digest")).alias("lossless"),
    )


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(documents(spark, sf_dir), PIECES)


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(documents(spark, sf_dir), WORDS)


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_quality(documents(spark, sf_dir), labels(spark, sf_dir))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine_phrases(documents(spark, sf_dir))


OP11_SQL = r"""
with pieces as (
    select row_number() over () as piece, lang, words from (
        select coalesce(lang, 'und') as lang, regexp_extract_all(unnest(regexp_extract_all(
            translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^.,;:!?\x0A-\x0D]+'
        )), '[^\x20\x09]+') as words
        from documents
    )
), tokens as (
    select piece, lang, unnest(words) as w1, generate_subscripts(words, 1) as i from pieces
), runs as (
    select lang, w1, lead(w1) over p as w2, lead(w1, 2) over p as w3 from tokens window p as (partition by piece order by i)
), totals as (select lang, count(*) as n from tokens group by lang),
one as (select lang, w1, count(*) as f from runs group by all),
two as (select lang, w1, w2, count(*) as f from runs where w2 is not null group by all having count(*) >= 10),
three as (select lang, w1, w2, w3, count(*) as f from runs where w3 is not null group by all having count(*) >= 10),
covers as (
    select lang, w1, w2, max(f) as longer from (
        select lang, w1, w2, f from three union all select lang, w2, w3, f from three
    ) group by all
), cuts as (
    select t.lang, t.w1 || ' ' || t.w2 as phrase, t.f as a, 1 as k, a.f as l, b.f as r
    from two t join one a on a.lang = t.lang and a.w1 = t.w1 join one b on b.lang = t.lang and b.w1 = t.w2
    left join covers c on c.lang = t.lang and c.w1 = t.w1 and c.w2 = t.w2
    where c.longer is null or 100 * c.longer < 50 * t.f
    union all
    select t.lang, t.w1 || ' ' || t.w2 || ' ' || t.w3, t.f, 1, a.f, b.f
    from three t join one a on a.lang = t.lang and a.w1 = t.w1
    join two b on b.lang = t.lang and b.w1 = t.w2 and b.w2 = t.w3
    union all
    select t.lang, t.w1 || ' ' || t.w2 || ' ' || t.w3, t.f, 2, a.f, b.f
    from three t join two a on a.lang = t.lang and a.w1 = t.w1 and a.w2 = t.w2
    join one b on b.lang = t.lang and b.w1 = t.w3
), scored as (
    select *, cast((1000000::hugeint * a * a) // (l::hugeint * r) as bigint) as score from cuts
    qualify row_number() over (partition by lang, phrase order by (1000000::hugeint * a * a) // (l::hugeint * r), k) = 1
)
select lang, row_number() over (partition by lang order by score desc, a desc, phrase) as rank, phrase, a, l, r, n, score
from scored join totals using (lang) qualify rank <= 2000
"""


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = negatives.whole_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    moved = F.when(F.col("id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine_negatives(vectors.withColumn("label", moved))


OP12_SQL = """
with rows as (
    select vec_id as id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
           [floor(256 * x::double) for x in embedding] as v
    from embeddings
    where vec_id is not null and label is not null and embedding is not null
      and len([x for x in embedding if x is null or not isfinite(x)]) = 0
), scores as (
    select a.id as anchor_id, b.id as other_id, a.label = b.label as same,
           cast(list_inner_product(a.v, b.v) as bigint) as score
    from rows a join rows b on a.id <> b.id where a.id % 100 = 0
), positives as (
    select anchor_id, other_id as positive_id, score as positive_score from scores where same
    qualify row_number() over (partition by anchor_id order by score desc, other_id) <= 5
)
select anchor_id, positive_id, cast(row_number() over best as integer) as rank, other_id as negative_id, positive_score,
       score as negative_score
from positives join scores using (anchor_id)
where not same and 30 * positive_score <= 100 * score and 100 * score <= 90 * positive_score
window best as (partition by anchor_id, positive_id order by score desc, other_id)
qualify row_number() over best <= 10
"""


def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_toxicity(documents(spark, sf_dir), labels(spark, sf_dir))


QUERIES = {
    "op1_ngram_join": (op1_ngram_join, None),
    "op2_licenses": (op2_licenses, OP2_SQL),
    "op3_ppm": (op3_ppm, None),
    "op4_exact_dedup": (op4_exact_dedup, OP4_SQL),
    "op5_pii": (op5_pii, None),
    "op6_line_rules": (op6_line_rules, None),
    "op7_pieces": (op7_pieces, None),
    "op8_token_counts": (op8_token_counts, None),
    "op9_packing": (op9_packing, None),
    "op10_quality": (op10_quality, None),
    "op11_collocations": (op11_collocations, OP11_SQL),
    "op12_hard_negatives": (op12_hard_negatives, OP12_SQL),
    "op13_toxicity": (op13_toxicity, None),
}
