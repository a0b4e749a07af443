"""Wide categorical columns: ranked dictionary, joined places, saved with the model."""

import random

import pytest
from pyspark.sql import functions as F

from riskloom.operators.dictionary import build_dictionary, level_counts, level_summary, read_dictionary
from riskloom.operators.preprocess import TabularPreprocessor, TabularPreprocessorModel


@pytest.fixture(scope="module")
def frame(spark):
    rng = random.Random(2)
    rows = [(i, rng.choice([None, "hot", "hot", f"v{rng.randint(0, 400)}", f"é{i}", ""]), rng.choice(["a", "b", None]), rng.random()) for i in range(1500)]
    return rows, spark.createDataFrame(rows, "k long, wide string, narrow string, x double").repartition(6)


def test_places_are_ranks_in_binary_order(spark, frame):
    rows, df = frame
    counts = level_counts(df, ["wide", "narrow"])
    found = {(r["name"], r["value"]): (r["place"], r["n"]) for r in read_dictionary(spark, build_dictionary(counts)).collect()}
    for c, at in (("wide", 1), ("narrow", 2)):
        values = [r[at] for r in rows if r[at] is not None]
        levels = sorted(set(values), key=str.encode)
        assert {k[1]: v for k, v in found.items() if k[0] == c} == {v: (n, values.count(v)) for n, v in enumerate(levels)}
    seen = {r["name"]: (r["levels"], r["mode"], r["rows"]) for r in level_summary(counts).collect()}
    assert seen["wide"][1] == "hot" and seen["narrow"][0] == 2


@pytest.mark.parametrize("held", [1, 2, 10_000])
def test_vectors_do_not_depend_on_where_levels_are_held(spark, frame, tmp_path, held):
    rows, df = frame
    train = df.filter("k % 3 > 0")
    model = TabularPreprocessor(inputCols=["wide", "x", "narrow"], heldLevels=held).fit(train)
    path = str(tmp_path / "model")
    model.write().save(path)
    loaded = TabularPreprocessorModel.load(path)
    plain = TabularPreprocessor(inputCols=["wide", "x", "narrow"]).fit(train)
    want = {r["k"]: r["features"] for r in plain.transform(df).select("k", "features").collect()}
    assert loaded.output_size() == len(plain.output_names()) == len(next(iter(want.values())))
    for m in (model, loaded):
        assert {r["k"]: r["features"] for r in m.transform(df).select("k", "features").collect()} == want
    assert [r["name"] for r in loaded.output_table(spark).orderBy("position").collect()] == plain.output_names()
    if held < 100:
        with pytest.raises(ValueError, match="too many levels"):
            loaded.output_names()


def test_unseen_and_missing_values(spark, frame):
    _, df = frame
    model = TabularPreprocessor(inputCols=["wide"], heldLevels=5).fit(df)
    made = model.transform(spark.createDataFrame([(1, "never seen"), (2, None), (3, "hot")], "k long, wide string"))
    by = {r["k"]: r["features"] for r in made.collect()}
    assert by[1].numNonzeros() == 0 and by[2] == by[3] and by[2].numNonzeros() == 1
    assert made.columns == ["k", "wide", "features"]


def test_levels_do_not_pass_through_the_driver(spark, frame, monkeypatch):
    _, df = frame
    from pyspark.sql.classic.dataframe import DataFrame

    sizes = []
    real = DataFrame.toArrow
    monkeypatch.setattr(DataFrame, "toArrow", lambda self: sizes.append(len(t := real(self))) or t)
    TabularPreprocessor(inputCols=["wide", "narrow"], heldLevels=20).fit(df)
    assert max(sizes) <= 41
    assert df.select(F.count_distinct("wide")).first()[0] > 400
