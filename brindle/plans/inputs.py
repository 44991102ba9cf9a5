"""Job inputs derived from the given tables, and the same rows as SQL.

Every input covers its whole table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from brindle.session import materialize, spread

STOPWORDS = ["the", "and", "of", "to", "in", "a", "is", "that", "for", "on"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread_table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """Columns of a table for work that is heavy per row; a scan in few splits is spread."""
    return spread(table(spark, sf_dir, name).select(*columns))


# --- access log lines, from events -------------------------------------------------------------


def log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One log line per event; those with one certain property are there once more, without quotes."""
    code = F.expr(
        "case event_type when 'signup' then '304' when 'purchase' then '302' "
        "when 'error' then '404' else '200' end"
    )
    size = F.when(code == "304", "-").otherwise(F.floor(F.col("value") * 100).cast("string"))
    quotes = F.when(F.col("props") == '{"k": 13}', F.array(F.lit('"'), F.lit(""))).otherwise(F.array(F.lit('"')))
    time = F.date_format("ts", "dd/MMM/yyyy:HH:mm:ss")
    source = spread_table(spark, sf_dir, "events", "ts", "user_id", "event_type", "value", "props")
    quote = F.col("quote")
    return source.withColumn("quote", F.explode(quotes)).select(
        F.concat(
            F.format_string("u%d.example.com - - [", "user_id"),
            time,
            F.lit(" -0400] "),
            quote,
            F.format_string("GET /%s/%d HTTP/1.0", "event_type", F.col("user_id") % 7),
            quote,
            F.lit(" "),
            code,
            F.lit(" "),
            size,
        ).alias("value")
    )


LOGS_SQL = """
all_logs as (
  select 'u' || user_id || '.example.com' as host, date_trunc('second', ts) as date_time,
         '/' || event_type || '/' || (user_id % 7) as endpoint,
         case event_type when 'signup' then 304 when 'purchase' then 302
                         when 'error' then 404 else 200 end as response_code,
         case when event_type = 'signup' then 0
              else cast(floor(value * 100) as bigint) end as content_size,
         props = '{"k": 13}' as spoilt
  from events),
logs as (select * from all_logs)
"""


# --- two catalogues, from documents -------------------------------------------------------------


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`side, id, text`: the sources numbered below 10 are catalogue a, the others b."""
    number = F.expr("cast(substring(source, 4) as int)")
    source = spread_table(spark, sf_dir, "documents", "doc_id", "source", "text")
    return source.select(
        F.when(number < 10, "a").otherwise("b").alias("side"), F.col("doc_id").alias("id"), "text"
    )


def catalogue(spark: SparkSession, sf_dir: str, side: str) -> DataFrame:
    return documents(spark, sf_dir).where(F.col("side") == side).select("id", "text")


def gold_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`id_a, id_b`: every record of b with the first record of a that has the same text."""
    docs = documents(spark, sf_dir).select("side", "id", F.md5("text").alias("content"))
    first = docs.where("side = 'a'").groupBy("content").agg(F.min("id").alias("id_a"))
    other = docs.where("side = 'b'").select("content", F.col("id").alias("id_b"))
    return other.join(materialize(first, "first-texts"), "content").select("id_a", "id_b")


def record_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quoted catalogue lines with a header; records of short texts have a line without quotes too."""
    clean = F.regexp_replace("text", '["\r\n]', " ")
    docs = spread_table(spark, sf_dir, "documents", "doc_id", "text", "lang", "source", "n_chars")
    good = F.concat(
        F.lit('"'), F.col("doc_id").cast("string"), F.lit('","'), clean, F.lit('","'), F.col("lang"),
        F.lit('","'), F.col("source"), F.lit('","'), F.col("n_chars").cast("string"), F.lit('"'),
    )
    bad = F.concat(F.lit("unquoted "), F.col("doc_id").cast("string"))
    # Fixed value: the header of the record file.
    header = spark.range(1).select(
        F.lit('"id","title","description","manufacturer","price"').alias("value")
    )
    lines = F.when(F.col("n_chars") < 10, F.array(good, bad)).otherwise(F.array(good))
    return docs.select(F.explode(lines).alias("value")).unionByName(header)


RECORDS_SQL = f"""
recs as (
  select doc_id as id, text,
         case when cast(substr(source, 4) as int) < 10 then 'a' else 'b' end as side,
         list_filter(regexp_split_to_array(lower(text), '\\W+'),
                     lambda w: w <> '' and w not in ({", ".join(f"'{w}'" for w in STOPWORDS)})) as tokens
  from documents)
"""

WEIGHTS_SQL = (
    RECORDS_SQL
    + """,
words as (select id, side, len(tokens) as n, unnest(tokens) as token from recs),
tf as (select id, side, token, count(*) / any_value(n) as tf from words group by id, side, token),
idf as (select token, (select count(distinct id) from recs) / count(*) as idf from tf group by token),
weights as (select tf.id, tf.side, tf.token, tf * idf as weight from tf join idf using (token)),
norms as (select id, side, sqrt(sum(weight * weight)) as norm from weights group by id, side)
"""
)

GOLD_SQL = """
gold as (
  select a.id_a, b.id as id_b
  from (select * from recs where side = 'b') b
  join (select text, min(id) as id_a from recs where side = 'a' group by text) a using (text))
"""

SIMS_SQL = """
sims as (
  select x.id as id_a, y.id as id_b, count(*) as n_common,
         sum(x.weight * y.weight) / any_value(nx.norm * ny.norm) as sim
  from weights x join weights y on x.token = y.token and x.side = 'a' and y.side = 'b'
  join norms nx on nx.id = x.id join norms ny on ny.id = y.id
  group by x.id, y.id)
"""


# --- ratings, from lineitem ---------------------------------------------------------------------


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`user, item, rating`: suppliers rate parts; pairs repeat."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").cast("int").alias("user"),
        F.col("l_partkey").cast("int").alias("item"),
        (F.col("l_quantity").cast("int") % 5 + 1).cast("double").alias("rating"),
    )


def titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("int").alias("item"),
        F.concat_ws(" ", "p_name", F.col("p_partkey").cast("string")).alias("title"),
    )


RATINGS_SQL = """
ratings as (
  select cast(l_suppkey as int) as user_id, cast(l_partkey as int) as item,
         cast(1 + cast(l_quantity as int) % 5 as double) as rating
  from lineitem),
titles as (select cast(p_partkey as int) as item, p_name || ' ' || p_partkey as title from part)
"""


# --- labelled points, from lineitem -------------------------------------------------------------

SPLIT_WEIGHTS = [0.8, 0.1, 0.1]
SPLIT_SEED = 42


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`key, label, features`: the ship year and four scaled measures."""
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("key"),
        F.year("l_shipdate").cast("double").alias("label"),
        F.array(
            F.col("l_quantity") / 50.0,
            F.col("l_extendedprice") / 105000.0,
            F.col("l_discount") * 10.0,
            F.col("l_tax") * 12.5,
        ).alias("features"),
    )


def unit_sql(*parts: str) -> str:
    """The SQL of `unit_hash`."""
    text = " || '|' || ".join(f"cast({p} as varchar)" for p in parts)
    return f"(cast('0x' || substr(md5({text}), 1, 13) as bigint) / {float(1 << 52)!r})"


POINTS_SQL = f"""
raw_points as (
  select l_orderkey as key, cast(year(l_shipdate) as double) as label,
         l_quantity / 50.0::double as x1, l_extendedprice / 105000.0::double as x2,
         l_discount * 10.0::double as x3, l_tax * 12.5::double as x4
  from lineitem),
points as (
  select key, label - (select min(label) from raw_points) as label, x1, x2, x3, x4,
         case when {unit_sql(SPLIT_SEED, "key")} < 0.8::double then 0
              when {unit_sql(SPLIT_SEED, "key")} < 0.9::double then 1 else 2 end as split
  from raw_points)
"""


# --- pixel series, from embeddings --------------------------------------------------------------

SERIES_LENGTH, SERIES_PERIOD = 64, 8


def series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`x, y, ts`: vectors as series, moved away from zero."""
    return table(spark, sf_dir, "embeddings").select(
        F.expr("cast(vec_id div 25 as int)").alias("x"),
        (F.col("vec_id") % 25).cast("int").alias("y"),
        F.transform("embedding", lambda v: v.cast("double") + 1.0).alias("ts"),
    )


SERIES_SQL = """
series as (
  select vec_id, cast(vec_id // 25 as int) as x, cast(vec_id % 25 as int) as y,
         list_transform(embedding, lambda v: cast(v as double) + 1.0::double) as ts
  from embeddings),
cells as (select vec_id, x, y, unnest(range(64)) as i, unnest(ts) as v from series)
"""


# --- boxes, from lineitem -----------------------------------------------------------------------

BOX_ORDER = ["xmin", "ymin", "xmax", "ymax", "label", "confidence"]
ANCHORS = [  # Fixed values: the nine default anchors
    (10, 13), (16, 30), (33, 23), (30, 61), (62, 45), (59, 119), (116, 90), (156, 198), (373, 326),
]


def raw_boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boxes of images made of eight orders each; exact copies occur."""
    number = F.expr("l_orderkey div 8")
    x0, y0 = (F.col("l_partkey") % 300).cast("double"), (F.col("l_suppkey") % 200).cast("double")
    source = spread_table(
        spark, sf_dir, "lineitem", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
        "l_quantity", "l_discount", "l_returnflag",
    )
    return source.select(
        F.format_string("img%d.jpg", number).alias("image"),
        x0.alias("xmin"),
        y0.alias("ymin"),
        (x0 + F.col("l_quantity") * 2 + 0.5).alias("xmax"),
        (y0 + F.col("l_linenumber") * 13 + 5.5).alias("ymax"),
        F.col("l_returnflag").alias("label"),
        F.round(F.col("l_discount") * 10, 4).alias("confidence"),
        (number % 7 * 40 + 200).cast("int").alias("x_size"),
        (number % 5 * 60 + 160).cast("int").alias("y_size"),
    )


def boxes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_boxes(spark, sf_dir).dropDuplicates()


BOXES_SQL = """
raw_boxes as (
  select 'img' || (l_orderkey // 8) || '.jpg' as image,
         cast(l_partkey % 300 as double) as xmin, cast(l_suppkey % 200 as double) as ymin,
         cast(l_partkey % 300 as double) + l_quantity * 2 + 0.5::double as xmax,
         cast(l_suppkey % 200 as double) + l_linenumber * 13 + 5.5::double as ymax,
         l_returnflag as label, round(l_discount * 10, 4) as confidence,
         cast((l_orderkey // 8) % 7 * 40 + 200 as int) as x_size,
         cast((l_orderkey // 8) % 5 * 60 + 160 as int) as y_size
  from lineitem),
boxes as (select distinct * from raw_boxes)
"""


def with_sql(*ctes: str, query: str, recursive: bool = False) -> str:
    return f"with {'recursive ' if recursive else ''}" + ",".join(ctes) + query


def determinant_sql(rows: list[list[str]]) -> str:
    """The determinant of a square of SQL terms, by its first row."""
    if len(rows) == 1:
        return rows[0][0]
    parts = []
    for j, term in enumerate(rows[0]):
        rest = [row[:j] + row[j + 1 :] for row in rows[1:]]
        parts.append(f"{'-' if j % 2 else '+'} ({term}) * ({determinant_sql(rest)})")
    return " ".join(parts).removeprefix("+ ")


def solution_sql(left: list[list[str]], right: list[str]) -> list[str]:
    """The unknowns of linear equations by the rule of Cramer."""
    whole = determinant_sql(left)
    found = []
    for j in range(len(right)):
        replaced = [row[:j] + [right[i]] + row[j + 1 :] for i, row in enumerate(left)]
        found.append(f"(({determinant_sql(replaced)}) / ({whole}))")
    return found
