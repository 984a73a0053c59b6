from propensity.llm import simhash_gray as S

A = "The harbour was quiet when the first boats came in with the morning tide and nobody spoke a word about the storm."
B = "Seven engineers argued for hours over a bridge that would never be built because the valley had long been flooded."
C = "Grandmother kept recipes for plum cake, rye bread and pickled beans in a tin box below the kitchen window."


def kept(spark, rows):
    return sorted(map(tuple, S.representatives(spark.createDataFrame(rows, "doc_id long, text string")).collect()))


def test_rows_that_share_an_id_but_not_a_text_stay(spark):
    assert kept(spark, [(5, A), (5, B), (5, A), (9, B), (9, C), (11, C)]) == sorted([(5, A), (5, B), (9, C)])


def test_given_columns_keep_their_values_whatever_their_names(spark, clash, none):
    rows = [(1, A, 77, "x", "r"), (2, A, 78, "y", "s"), (3, B, None, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, _near_id long, _near_text string, row string")
    assert sorted(map(tuple, S.representatives(df).collect())) == [rows[0], rows[2]]
    assert S.representatives(clash).columns == clash.columns and S.representatives(none).count() == 0
