"""Record-linkage queries over two catalogues of whole texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from brindle.operators import linkage as ops
from brindle.plans.inputs import (
    GOLD_SQL,
    RECORDS_SQL,
    SIMS_SQL,
    STOPWORDS,
    WEIGHTS_SQL,
    catalogue,
    documents,
    gold_pairs,
    record_lines,
    with_sql,
)
from brindle.session import materialize, scratch_folder
from brindle.sources.records import load, parse_pairs, parse_records, status_counts, valid
from brindle.sources.sinks import write_lines
from brindle.sources.text import literal_table, read_words

# Similarity from which pairs are listed: the condition of the join.
MIN_SIM = 0.05
# Thresholds are rated by hundredths; from the first one on they need pairs.
FIRST_THRESHOLD = 0.01


def tokens(spark: SparkSession, sf_dir: str, side: str | None = None) -> DataFrame:
    records = documents(spark, sf_dir) if side is None else catalogue(spark, sf_dir, side)
    return ops.token_table(records, STOPWORDS)


def index(spark: SparkSession, sf_dir: str) -> ops.LinkageIndex:
    return ops.build_index(tokens(spark, sf_dir, "a"), tokens(spark, sf_dir, "b"))


def _weights(spark, sf_dir, lists=()):
    """Texts are parsed once: both operators take the blocks."""
    blocks = ops.token_blocks(tokens(spark, sf_dir), ["id"])
    return ops.tfidf(blocks, ops.inverse_document_frequency(blocks), lists)


def _gold_lines(spark, sf_dir):
    pairs = gold_pairs(spark, sf_dir)
    lines = pairs.select(F.format_string('"%d","%d"', "id_a", "id_b").alias("value"))
    return lines.unionByName(spark.range(1).select(F.lit('"idAmazon","URL"').alias("value")))


def _gold_ingest(spark, sf_dir):
    pairs = valid(parse_pairs(_gold_lines(spark, sf_dir)))
    return pairs.select(F.col("id_a").cast("long"), F.col("id_b").cast("long"))


def _load(spark, sf_dir):
    """The counts that came with the scan which wrote the records, and the rows written."""
    rows, counts = load(parse_records(record_lines(spark, sf_dir)), name="records")
    return rows.agg(*[F.lit(v).cast("long").alias(k) for k, v in counts.items()], F.count(F.lit(1)).alias("n_written"))


def _records(spark, sf_dir):
    return valid(parse_records(record_lines(spark, sf_dir)))


def _similar(spark, sf_dir):
    return ops.similar_pairs(index(spark, sf_dir), MIN_SIM).withColumn("sim", F.round("sim", 6))


def _similar_records(spark, sf_dir):
    built = index(spark, sf_dir)
    pairs = ops.expand_pairs(built, ops.similar_pairs(built, MIN_SIM))
    return pairs.withColumn("sim", F.round("sim", 6))


def _common(spark, sf_dir):
    built = index(spark, sf_dir)
    found = ops.common_tokens(built, ops.similar_pairs(built, MIN_SIM))
    return found.select("vid_a", "vid_b", F.array_join("tokens", " ").alias("tokens"))


def _scored(built, spark, sf_dir):
    return materialize(ops.score_pairs(built, gold_pairs(spark, sf_dir)), "gold-scores")


def _gold_scores(spark, sf_dir):
    scored = ops.score_pairs(index(spark, sf_dir), gold_pairs(spark, sf_dir))
    return scored.withColumn("sim", F.round("sim", 6))


def _tokens_long(spark, sf_dir):
    """The tokens with the stopwords read from a word file and taken out by a join."""
    folder = scratch_folder(spark, "stopwords")
    write_lines(literal_table(spark, [(w,) for w in STOPWORDS], "line string"), folder)
    found = ops.tokens_without(documents(spark, sf_dir), read_words(spark, folder))
    return found.select(
        "id", F.size("tokens").cast("long").alias("n"), F.array_join("tokens", " ").alias("tokens")
    )


def _gold_map_scores(spark, sf_dir):
    """Gold pairs scored from whole vectors, which are written once."""
    vectors = ops.weight_maps(_weights(spark, sf_dir, ["tokens", "weights"]))
    found = ops.score_chosen(materialize(gold_pairs(spark, sf_dir), "gold"), vectors, vectors)
    return found.withColumn("sim", F.round("sim", 6))


def _dups(spark, sf_dir):
    scored = ops.score_pairs(index(spark, sf_dir), gold_pairs(spark, sf_dir))
    return ops.duplicate_average(scored).withColumn("avg_sim", F.round("avg_sim", 6))


def _nondups(spark, sf_dir):
    built = index(spark, sf_dir)
    scored = _scored(built, spark, sf_dir)
    return ops.other_average(built, scored).withColumn("avg_sim", F.round("avg_sim", 9))


def _eval(spark, sf_dir):
    built = index(spark, sf_dir)
    scored = _scored(built, spark, sf_dir)
    sims = ops.similar_pairs(built, FIRST_THRESHOLD)
    rated = ops.evaluate(sims, scored, FIRST_THRESHOLD, n_pairs=ops.pair_count(built))
    return rated.select(
        F.round("threshold", 2).alias("threshold"), "tp", "fp", "fn",
        *[F.round(c, 6).alias(c) for c in ("precision", "recall", "f_measure")],
    )


def _biggest(spark, sf_dir):
    return ops.biggest_record(tokens(spark, sf_dir, "a"))


_VECTORS = """,
vectors as (select id, side, min(id) over (partition by side, tokens) as vid,
                   count(*) over (partition by side, tokens) as copies from recs)
"""
_CLEAN = "regexp_replace(text, '[\"\\r\\n]', ' ', 'g')"
_SIMILAR = (WEIGHTS_SQL, SIMS_SQL)

QUERIES = {
    "er_ingest": (
        lambda spark, sf_dir: _records(spark, sf_dir).withColumn("id", F.col("id").cast("long")),
        f"select doc_id as id, {_CLEAN} || ' \"' || lang || '\" \"' || source || '\"' as text "
        "from documents",
    ),
    "er_ingest_status": (
        lambda spark, sf_dir: status_counts(parse_records(record_lines(spark, sf_dir))),
        "select count(*) + 1 + count(*) filter (where n_chars < 10) as n_read, count(*) as n_ok, "
        "cast(1 as bigint) as n_header, count(*) filter (where n_chars < 10) as n_bad from documents",
    ),
    "er_load": (
        _load,
        "select count(*) + 1 + count(*) filter (where n_chars < 10) as n_read, count(*) as n_ok, "
        "cast(1 as bigint) as n_header, count(*) filter (where n_chars < 10) as n_bad, count(*) as n_written from documents",
    ),
    "er_gold_ingest": (
        _gold_ingest,
        with_sql(RECORDS_SQL, GOLD_SQL, query="select id_a, id_b from gold"),
    ),
    "er_tokens": (
        lambda spark, sf_dir: tokens(spark, sf_dir).select(
            "id", F.size("tokens").cast("long").alias("n"), F.array_join("tokens", " ").alias("tokens")
        ),
        with_sql(
            RECORDS_SQL,
            query="select id, len(tokens) as n, array_to_string(tokens, ' ') as tokens from recs",
        ),
    ),
    "er_token_count": (
        lambda spark, sf_dir: ops.token_count(tokens(spark, sf_dir)),
        with_sql(RECORDS_SQL, query="select cast(sum(len(tokens)) as bigint) as n_tokens from recs"),
    ),
    "er_biggest": (
        _biggest,
        with_sql(
            RECORDS_SQL,
            query="select id, len(tokens) as n_tokens from recs where side = 'a' "
            "order by n_tokens desc, id limit 1",
        ),
    ),
    "er_tf": (
        lambda spark, sf_dir: ops.term_frequency(tokens(spark, sf_dir)).withColumn("tf", F.round("tf", 9)),
        with_sql(WEIGHTS_SQL, query="select id, token, round(tf, 9) as tf from tf"),
    ),
    "er_idf": (
        lambda spark, sf_dir: ops.inverse_document_frequency(tokens(spark, sf_dir)).withColumn(
            "idf", F.round("idf", 6)
        ),
        with_sql(WEIGHTS_SQL, query="select token, round(idf, 6) as idf from idf"),
    ),
    "er_idf_smallest": (
        lambda spark, sf_dir: ops.smallest_idf(
            ops.inverse_document_frequency(tokens(spark, sf_dir))
        ).withColumn("idf", F.round("idf", 6)),
        with_sql(
            WEIGHTS_SQL,
            query="select token, round(idf, 6) as idf from "
            "(select * from idf order by idf, token limit 11)",
        ),
    ),
    "er_idf_histogram": (
        lambda spark, sf_dir: ops.histogram(
            materialize(ops.inverse_document_frequency(tokens(spark, sf_dir)), "idf"), "idf"
        ),
        with_sql(
            WEIGHTS_SQL,
            query="select cast(least(floor((idf - lo) * 50 / (hi - lo)), 49) as bigint) as bin, "
            "count(*) as n from idf, (select min(idf) as lo, max(idf) as hi from idf) group by 1",
        ),
    ),
    "er_tfidf": (
        lambda spark, sf_dir: _weights(spark, sf_dir).withColumn("weight", F.round("weight", 6)),
        with_sql(WEIGHTS_SQL, query="select id, token, round(weight, 6) as weight from weights"),
    ),
    "er_norms": (
        lambda spark, sf_dir: ops.norms(_weights(spark, sf_dir, lists=["weights"])).withColumn("norm", F.round("norm", 6)),
        with_sql(WEIGHTS_SQL, query="select id, round(norm, 6) as norm from norms"),
    ),
    "er_common_tokens": (
        _common,
        with_sql(
            *_SIMILAR,
            query=_VECTORS
            + ", picked as (select id_a, id_b from sims join vectors a on a.id = id_a and a.vid = a.id "
            f"join vectors b on b.id = id_b and b.vid = b.id where sim >= {MIN_SIM}) "
            "select id_a as vid_a, id_b as vid_b, string_agg(x.token, ' ' order by x.token) as tokens "
            "from picked join tf x on x.id = id_a join tf y on y.id = id_b and x.token = y.token "
            "group by id_a, id_b",
        ),
    ),
    "er_cosine": (
        _similar,
        with_sql(
            *_SIMILAR,
            query=_VECTORS
            + "select id_a as vid_a, id_b as vid_b, a.copies as copies_a, b.copies as copies_b, "
            "n_common, round(sim, 6) as sim from sims "
            "join vectors a on a.id = id_a and a.vid = a.id "
            f"join vectors b on b.id = id_b and b.vid = b.id where sim >= {MIN_SIM}",
        ),
    ),
    "er_similar_records": (
        _similar_records,
        with_sql(
            *_SIMILAR, query=f"select id_a, id_b, round(sim, 6) as sim from sims where sim >= {MIN_SIM}"
        ),
    ),
    "er_members": (
        lambda spark, sf_dir: index(spark, sf_dir).members.select("side", "id", "vid"),
        with_sql(RECORDS_SQL, query=_VECTORS + "select side, id, vid from vectors where id in (select id from recs where len(tokens) > 0)"),
    ),
    "er_lookup": (
        lambda spark, sf_dir: ops.lookup(
            tokens(spark, sf_dir, "a"), tokens(spark, sf_dir, "b"), 0, 10
        ).withColumn("sim", F.round("sim", 9)),
        with_sql(
            *_SIMILAR,
            query="select p.id_a, p.id_b, round(coalesce(sim, 0), 9) as sim "
            "from (select 0 as id_a, 10 as id_b) p left join sims using (id_a, id_b)",
        ),
    ),
    "er_gold_scores": (
        _gold_scores,
        with_sql(
            *_SIMILAR,
            GOLD_SQL,
            query="select g.id_a, g.id_b, coalesce(n_common, 0) as n_common, "
            "round(coalesce(sim, 0), 6) as sim from gold g left join sims using (id_a, id_b)",
        ),
    ),
    "er_gold_map_scores": (
        _gold_map_scores,
        with_sql(
            *_SIMILAR,
            GOLD_SQL,
            query="select g.id_a, g.id_b, coalesce(n_common, 0) as n_common, "
            "round(coalesce(sim, 0), 6) as sim from gold g left join sims using (id_a, id_b)",
        ),
    ),
    "er_tokens_long": (
        _tokens_long,
        with_sql(
            RECORDS_SQL,
            query="select id, len(tokens) as n, array_to_string(tokens, ' ') as tokens from recs",
        ),
    ),
    "er_dups_avg": (
        _dups,
        with_sql(
            *_SIMILAR,
            GOLD_SQL,
            query="select count(*) as n_pairs, round(avg(sim), 6) as avg_sim "
            "from gold join sims using (id_a, id_b)",
        ),
    ),
    "er_nondups_avg": (
        _nondups,
        with_sql(
            *_SIMILAR,
            GOLD_SQL,
            query="""
            select count(*) as n_pairs, round(sum(coalesce(sim, 0)) / count(*), 9) as avg_sim
            from (select a.id as id_a, b.id as id_b
                  from recs a join recs b on a.side = 'a' and b.side = 'b') p
            left join sims using (id_a, id_b)
            where not exists (select 1 from gold join sims using (id_a, id_b)
                              where gold.id_a = p.id_a and gold.id_b = p.id_b)""",
        ),
    ),
    "er_eval": (
        _eval,
        with_sql(
            *_SIMILAR,
            GOLD_SQL,
            query=""",
            scored as (select g.id_a, g.id_b, coalesce(sim, 0) as sim
                       from (select distinct * from gold) g left join sims using (id_a, id_b)),
            others as (select cast(trunc(sim * 100) as int) as bin from sims
                       where not exists (select 1 from gold g where g.id_a = sims.id_a and g.id_b = sims.id_b)),
            grid as (select unnest(range(0, 100)) as i),
            counted as (
              select i / 100 as threshold,
                     case when i = 0 then (select count(*) filter (where side = 'a') * count(*) filter (where side = 'b')
                                           from recs) - (select count(*) from scored)
                          else (select count(*) from others where bin >= i) end as fp,
                     (select count(*) from scored where sim < i / 100) as fn,
                     (select count(*) from scored) as n_gold
              from grid),
            rated as (select threshold, n_gold - fn as tp, fp, fn,
                             (n_gold - fn) / nullif(n_gold - fn + fp, 0) as p, (n_gold - fn) / nullif(n_gold, 0) as r
                      from counted)
            select round(threshold, 2) as threshold, tp, fp, fn, round(p, 6) as precision,
                   round(r, 6) as recall, round(2 * p * r / nullif(p + r, 0), 6) as f_measure from rated""",
        ),
    ),
}
