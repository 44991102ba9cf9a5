"""Linkage against plain Python over all pairs."""

import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from brindle.functions.arrays import map_cosine, map_dot, map_norm
from brindle.functions.text import strip_quotes, token_counts, tokenize
from brindle.operators import linkage as ops
from brindle.sources.records import check_load, failed, parse_pairs, parse_records, status_counts, valid

FOX = "A quick brown fox jumps over the lazy dog."
STOP = ["a", "the", "over"]


def one(spark, column, **values):
    row = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()])
    return row.select(column.alias("v")).first()["v"]


def test_tokenize(spark):
    assert one(spark, tokenize(F.col("s")), s=FOX) == "a quick brown fox jumps over the lazy dog".split()
    assert one(spark, tokenize(F.col("s"), STOP), s=FOX) == "quick brown fox jumps lazy dog".split()
    assert one(spark, tokenize(F.col("s")), s="  !! ") == []
    assert one(spark, tokenize(F.col("s")), s="été 42_x") == ["t", "42_x"]


def test_token_counts(spark):
    df = spark.createDataFrame([(["b", "a", "b"],), ([],), (["z"],)], "t array<string>")
    got = [r[0] for r in df.select(token_counts(F.col("t"))).collect()]
    assert [tuple(x) for x in got[0]] == [("a", 1), ("b", 2)]
    assert got[1] is None
    assert [tuple(x) for x in got[2]] == [("z", 1)]


def test_term_frequency(spark):
    records = ops.token_table(spark.createDataFrame([(1, FOX)], "id int, text string"), STOP)
    tf = {r["token"]: r["tf"] for r in ops.term_frequency(records).collect()}
    assert tf["quick"] == 1 / 6 and len(tf) == 6


def test_map_vectors(spark):
    a, b = {"foo": 2.0, "bar": 3.0, "baz": 5.0}, {"foo": 1.0, "bar": 0.0, "baz": 20.0}
    df = spark.createDataFrame([(a, b)], "a map<string,double>, b map<string,double>")
    dot, norm, cosine = df.select(
        map_dot(F.col("a"), F.col("b")), map_norm(F.col("a")), map_cosine(F.col("a"), F.col("b"))
    ).first()
    assert dot == 102
    assert norm == pytest.approx(math.sqrt(38))
    assert cosine == pytest.approx(102 / math.sqrt(38) / math.sqrt(401))


def test_strip_quotes(spark):
    assert one(spark, strip_quotes(F.col("s")), s='"x"') == "x"
    assert one(spark, strip_quotes(F.col("s")), s='x"') == 'x"'


def test_record_routing(spark):
    lines = [
        '"id","title","description","manufacturer","price"',
        '"b01","one, two","some, text","maker",9.99',
        "not a record",
    ]
    parsed = parse_records(spark.createDataFrame([(s,) for s in lines], "value string"))
    assert tuple(status_counts(parsed).first()) == (3, 1, 1, 1)
    assert tuple(valid(parsed).first()) == ("b01", 'one, two "some, text" "maker"')
    assert [r["line"] for r in failed(parsed).collect()] == ["not a record"]
    with pytest.raises(Exception, match="failed to parse"):
        check_load(parsed).collect()
    clean = parse_records(spark.createDataFrame([(s,) for s in lines[:2]], "value string"))
    assert check_load(clean).first()["n_ok"] == 1


def test_pair_routing(spark):
    lines = ['"idAmazon","URL"', '"b0","http://x/1"', "nothing"]
    parsed = parse_pairs(spark.createDataFrame([(s,) for s in lines], "value string"))
    assert [r["status"] for r in parsed.collect()] == ["header", "ok", "bad"]
    assert tuple(valid(parsed).first()) == ("b0", "http://x/1")


def corpus(seed, copies=6):
    """Zipf-like texts, with a group of copies and a group of near copies on both sides."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(120)]
    weights = [1 / (i + 1) for i in range(120)]

    def text():
        return rng.choices(words, weights, k=rng.randint(1, 25))

    copied, base = text(), text() + text()
    sides = []
    for start in (0, 1000):
        rows = [text() for _ in range(25)]
        rows += [list(copied) for _ in range(copies)]
        rows += [base[:i] + [f"own{start + i}"] + base[i:] for i in range(copies)]
        rows.append([])
        sides.append([(start + i, t) for i, t in enumerate(rows)])
    return sides


def brute(a, b):
    n = len({i for i, _ in a + b})
    df = Counter(t for _, tokens in a + b for t in set(tokens))

    def vector(tokens):
        w = {t: c / len(tokens) * n / df[t] for t, c in Counter(tokens).items()}
        norm = math.sqrt(sum(v * v for v in w.values()))
        return {t: v / norm for t, v in w.items()}

    va, vb = ([(i, vector(t)) for i, t in side if t] for side in (a, b))
    sims = {}
    for i, x in va:
        for j, y in vb:
            common = x.keys() & y.keys()
            if common:
                sims[i, j] = sum(x[t] * y[t] for t in common)
    return sims


@pytest.fixture(scope="module", params=[1, 2])
def linked(spark, request):
    a, b = corpus(request.param)
    schema = "id int, tokens array<string>"
    index = ops.build_index(spark.createDataFrame(a, schema), spark.createDataFrame(b, schema))
    return a, b, index, brute(a, b)


@pytest.mark.parametrize("min_sim", [1e-6, 0.05, 0.3, 0.8])
def test_similar_pairs(linked, min_sim):
    _, _, index, sims = linked
    rows = ops.expand_pairs(index, ops.similar_pairs(index, min_sim)).collect()
    got = {(r["id_a"], r["id_b"]): r["sim"] for r in rows}
    assert len(rows) == len(got)
    assert got == pytest.approx({k: v for k, v in sims.items() if v >= min_sim})


def test_cells_do_not_change_pairs(linked):
    _, _, index, _ = linked
    whole, split = (
        sorted(map(tuple, ops.candidate_pairs(index, 0.05, cell_rows=n).collect())) for n in (5000, 3)
    )
    assert whole == split and whole


def test_copies_are_one_vector(linked):
    _, _, index, _ = linked
    assert max(r["copies_a"] for r in ops.similar_pairs(index, 0.9).collect()) >= 6


def test_scores_and_averages(spark, linked):
    a, b, index, sims = linked
    gold = [(a[i][0], b[i][0]) for i in range(len(a))] + [(5, 4321)]
    scored = ops.score_pairs(index, spark.createDataFrame(gold, "id_a int, id_b int"))
    got = {(r["id_a"], r["id_b"]): r["sim"] for r in scored.collect()}
    assert got == pytest.approx({p: sims.get(p, 0.0) for p in gold})
    found = [sims[p] for p in gold if p in sims]
    n, mean = ops.duplicate_average(scored).first()
    assert n == len(found) and mean == pytest.approx(sum(found) / len(found))
    n, mean = ops.other_average(index, scored).first()
    assert n == len(a) * len(b) - len(found)
    assert mean == pytest.approx((sum(sims.values()) - sum(found)) / n)
    pair = next(iter(sims))
    tables = [spark.createDataFrame(side, "id int, tokens array<string>") for side in (a, b)]
    assert ops.lookup(*tables, *pair).first()["sim"] == pytest.approx(sims[pair])
    assert ops.lookup(*tables, 5, 4321).first()["sim"] == 0.0


def test_repeated_ids_are_refused(spark):
    a = spark.createDataFrame([(1, ["x", "y"]), (1, ["z"])], "id int, tokens array<string>")
    b = spark.createDataFrame([(2, ["x"])], "id int, tokens array<string>")
    with pytest.raises(ValueError, match="side a has id 1"):
        ops.build_index(a, b)


def test_threshold_zero_links_everything(spark, linked):
    a, b, index, sims = linked
    gold = {(a[i][0], b[i][0]) for i in range(len(a))}
    scored = ops.score_pairs(index, spark.createDataFrame(list(gold), "id_a int, id_b int"))
    sims = ops.similar_pairs(index, 0.01)
    rated = ops.evaluate(sims, scored, 0.01, n_pairs=ops.pair_count(index)).orderBy("threshold").collect()
    assert [round(r["threshold"] * 100) for r in rated] == list(range(100))
    assert (rated[0]["tp"], rated[0]["fp"], rated[0]["fn"]) == (len(gold), len(a) * len(b) - len(gold), 0)
    rest = ops.evaluate(sims, scored, 0.01).orderBy("threshold").collect()
    assert rated[1:] == rest


def test_evaluation(spark, linked):
    a, b, index, sims = linked
    gold = {(a[i][0], b[i][0]) for i in range(len(a))}
    scored = ops.score_pairs(index, spark.createDataFrame(list(gold), "id_a int, id_b int"))
    rated = ops.evaluate(ops.similar_pairs(index, 0.02), scored, 0.02).collect()
    assert [round(r["threshold"] * 100) for r in rated] == list(range(2, 100))
    for r in rated:
        i = round(r["threshold"] * 100)
        fn = sum(sims.get(p, 0.0) < i / 100 for p in gold)
        fp = sum(int(s * 100 + 1e-9) >= i for p, s in sims.items() if p not in gold)
        assert (r["fn"], r["tp"]) == (fn, len(gold) - fn)
        assert abs(r["fp"] - fp) <= 0


def test_words_of_a_large_table_are_taken_out_in_order(spark):
    from brindle.operators import linkage

    rows = [(1, "The fox and the dog, the end"), (2, "the the"), (3, ""), (4, None), (5, "Fox fox THE fox")]
    records = spark.createDataFrame(rows, "id long, text string")
    stop = spark.createDataFrame([("the",), ("and",), ("the",)], "word string")
    found = {r.id: r.tokens for r in linkage.tokens_without(records, stop).collect()}
    assert found == {1: ["fox", "dog", "end"], 2: [], 3: [], 4: [], 5: ["fox", "fox", "fox"]}
    assert linkage.tokens_without(records, stop.where("false")).where("id = 2").first().tokens == ["the", "the"]


def test_chosen_pairs_from_maps(spark):
    from brindle.operators import linkage

    weights = spark.createDataFrame([(1, "a", 3.0), (1, "b", 4.0), (2, "a", 1.0), (3, "c", 2.0)], "id long, token string, weight double")
    vectors = linkage.weight_maps(weights)
    pairs = spark.createDataFrame([(1, 2), (1, 3), (1, 1), (1, 9)], "id_a long, id_b long")
    found = {(r.id_a, r.id_b): (r.n_common, round(r.sim, 9)) for r in linkage.score_chosen(pairs, vectors, vectors).collect()}
    assert found == {(1, 2): (1, 0.6), (1, 3): (0, 0.0), (1, 1): (2, 1.0), (1, 9): (0, 0.0)}


def test_maps_from_lists_are_those_from_rows(spark):
    """Lists of weights give the maps of their records; a second list of one id is refused."""
    rows = [(1, ["x", "y", "x"]), (2, ["y"]), (3, []), (4, None), (5, ["z"] * 9 + ["x"]), (6, ["z", "z"])]
    blocks = ops.token_blocks(spark.createDataFrame(rows, "id long, tokens array<string>"), ["id"], 4)
    idf = ops.inverse_document_frequency(blocks).where("token <> 'z'")
    maps = ops.weight_maps(ops.tfidf(blocks, idf, ["tokens", "weights"]))
    found = {r["id"]: r["vector"] for r in maps.collect()}
    assert sorted(found) == [1, 2, 5]
    assert found == {r["id"]: r["vector"] for r in ops.weight_maps(ops.tfidf(blocks, idf)).collect()}
    pairs = spark.createDataFrame([(1, 5), (1, 2), (2, 5), (6, 6), (None, 1)], "id_a long, id_b long")
    scores = {(r.id_a, r.id_b): (r.n_common, r.sim > 0) for r in ops.score_chosen(pairs, maps, maps).collect()}
    assert scores == {(1, 5): (1, True), (1, 2): (1, True), (2, 5): (0, False), (6, 6): (0, False), (None, 1): (0, False)}
    twice = spark.createDataFrame([(7, ["p"], [1.0]), (7, ["q"], [1.0])], "id long, tokens array<string>, weights array<double>")
    with pytest.raises(ValueError, match="id 7"):
        ops.weight_maps(twice)


def test_maps_are_not_exchanged(spark, monkeypatch):
    """`er_gold_map_scores` writes the maps where the blocks lie, and only vectors of the pairs go on."""
    from brindle.plans import linkage as plans

    written, write = {}, ops.materialize

    def spy(df, name):
        written[name] = df._jdf.queryExecution().executedPlan().toString()
        return write(df, name)

    monkeypatch.setattr(ops, "materialize", spy)
    scores = plans.QUERIES["er_gold_map_scores"][0](spark, "/root/testdata/sf0.001")
    maps = written["vectors"]
    assert "Exchange" not in maps[: maps.index("FlatMapCoGroupsInArrow")]
    assert scores._jdf.queryExecution().executedPlan().toString().count("LeftSemi") == 2


def test_tokens_are_counted_in_blocks_where_they_lie(spark):
    """An index has one row per vector, and blocks of any size give the same weights."""
    rows = [(1, ["x", "y", "x"]), (2, ["y"]), (3, []), (4, None), (5, ["z"] * 9 + ["x"]), (6, ["y"])]
    records = spark.createDataFrame(rows, "id long, tokens array<string>")
    blocks = [ops.token_blocks(records.coalesce(1), ["id"], most) for most in (1, 4, 1000)]
    assert [b.count() for b in blocks][2] == 1 and blocks[0].count() > blocks[1].count() > 1
    for b in blocks:
        assert sorted(r.id for r in b.selectExpr("inline(records)").collect()) == [1, 2, 3, 4, 5, 6]
        counts = b.selectExpr("inline(words)").groupBy("token").sum("df").collect()
        assert sorted(map(tuple, counts)) == [("x", 2), ("y", 3), ("z", 1)]
    weights = ops.tfidf(records, ops.inverse_document_frequency(records).where("token <> 'z'"))
    found = {(r["id"], r["token"]): r["weight"] for r in weights.collect()}
    assert found == pytest.approx({(1, "x"): 2 / 3 * 3, (1, "y"): 1 / 3 * 2, (2, "y"): 2, (5, "x"): 0.1 * 3, (6, "y"): 2})
    index = ops.build_index(records, records.where("id < 3"))
    assert index.vectors.count() == 5 and index.members.count() == 8


@pytest.mark.parametrize("most", [1, 4, 1000])
def test_weights_and_norms_from_blocks(spark, most):
    """Blocks give the weights and norms of their records, as rows or as lists; rows of one id count together."""
    rows = [(1, ["x", "y", "x"]), (2, ["y"]), (3, []), (4, None), (5, ["z"] * 9 + ["x"]), (6, ["z"]), (1, ["y"])]
    records = spark.createDataFrame(rows, "id long, tokens array<string>")
    blocks = ops.token_blocks(records.coalesce(1), ["id"], most)
    idf = ops.inverse_document_frequency(blocks)
    assert sorted(map(tuple, idf.collect())) == sorted(map(tuple, ops.inverse_document_frequency(records).collect()))
    some = idf.where("token <> 'z'")
    long = ops.tfidf(records, some)
    both = ops.tfidf(blocks, some, ["tokens", "weights"])
    assert sorted(map(tuple, both.selectExpr("id", "inline(arrays_zip(tokens, weights))").collect())) == sorted(map(tuple, long.collect()))
    lists = ops.tfidf(blocks, some, ["weights"])
    assert lists.columns == ["id", "weights"] and sorted(r["id"] for r in lists.collect()) == [1, 1, 2, 5]
    found = {r["id"]: r["norm"] for r in ops.norms(lists).collect()}
    assert found == pytest.approx({r["id"]: r["norm"] for r in ops.norms(long).collect()})
    assert found[1] == pytest.approx(math.sqrt((2 / 3 * 3) ** 2 + (1 / 3 * 2) ** 2 + 2**2))


def test_texts_are_parsed_once_for_norms(spark, monkeypatch):
    """The dictionary of `er_norms` comes from the blocks written, not from the texts again."""
    from brindle.plans import linkage as plans

    asked, idf = [], ops.inverse_document_frequency
    monkeypatch.setattr(ops, "inverse_document_frequency", lambda records: asked.append(idf(records)) or asked[-1])
    plans.QUERIES["er_norms"][0](spark, "/root/testdata/sf0.001")
    plan = asked[0]._jdf.queryExecution().optimizedPlan().toString()
    assert len(asked) == 1 and "split(" not in plan and "text" not in plan


def test_candidates_are_bounded_by_grades(linked):
    """Pairs that the frequent tokens cannot lift to the asked similarity are no candidates."""
    _, _, index, sims = linked
    n = ops.candidate_pairs(index, 0.3).count()
    wanted = ops.similar_pairs(index, 0.3).count()
    assert wanted <= n <= len(sims)


def test_pairs_are_not_exchanged(linked):
    """Candidates and their sums stay where a block of one side meets a block of the other."""
    _, _, index, _ = linked
    plan = ops.similar_pairs(index, 0.05)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" in plan and "hashpartitioning" not in plan and "Aggregate" not in plan


@pytest.mark.parametrize("products", [1, 7, 1 << 21])
def test_products_are_held_in_pieces(linked, monkeypatch, products):
    """A cell whose products are cut anywhere finds the same pairs."""
    import pyarrow as pa

    _, _, index, sims = linked
    monkeypatch.setattr(ops, "CELL_PRODUCTS", products)
    blocks = {}
    for side in "ab":
        rows = ops._vector_blocks(index, side, 0.05, 200).collect()
        columns = ["vids", "copies", "norms", "lengths", "known", "postings"]
        assert len(rows) > 1
        blocks[side] = [
            ops._Block({c: pa.array(r[f"{c}_{side}"]) if i < 3 else bytes(r[f"{c}_{side}"]) for i, c in enumerate(columns)}, index.total)
            for r in rows
        ]
    found = {}
    for a in blocks["a"]:
        for b in blocks["b"]:
            b.by_rank()
            into = ops.np.array([dict(zip(b.ranks.tolist(), range(len(b.ranks)))).get(r, -1) for r in a.ranks.tolist()])
            for x, y in ops._near(a, b, into, 0.05):
                n, sums = ops._whole_sums(a, b, into, x, y)
                assert (n > 0).all()
                found |= {(a.vids[int(i)].as_py(), b.vids[int(j)].as_py()): s for i, j, s in zip(x, y, sums) if s >= 0.05}
    own = {r["id"]: r["vid"] for r in index.members.collect()}
    assert found == pytest.approx({(own[i], own[j]): s for (i, j), s in sims.items() if s >= 0.05})


def test_common_tokens_meet_the_dictionary_in_blocks(spark, linked):
    """Tokens of every pair in order; rows of single tokens are neither exchanged nor grouped."""
    a, b, index, sims = linked
    pairs = ops.similar_pairs(index, 0.05)
    found = ops.common_tokens(index, pairs)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" not in plan and "collect_list" not in plan
    texts = dict(a) | dict(b)
    rows = found.collect()
    assert {(r.vid_a, r.vid_b) for r in rows} == {(r.vid_a, r.vid_b) for r in pairs.collect()} and len(rows) > 10
    for r in rows:
        assert r.tokens == sorted(set(texts[r.vid_a]) & set(texts[r.vid_b]))
