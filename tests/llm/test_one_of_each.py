"""One row of each group of near duplicates, whatever the table's columns are called."""

from siltstone.llm import ngram_join
from siltstone.llm.scratch import ship

TEXT = "one two three four five six seven eight nine ten"


def test_columns_keep_their_values_and_types(spark):
    ship(spark)
    schema = "doc_id long, text string, _row string, _row_ string, set_id string, n_shingles int, stays date"
    rows = [(1, TEXT, "a", "b", "c", 7, None), (2, TEXT, "d", None, "e", 8, None), (3, "another text", "f", "g", "h", 9, None),
            (3, "another text", "f", "g", "h", 9, None), (None, TEXT, "i", "j", "k", 1, None)]
    out = ngram_join.one_of_each(spark.createDataFrame(rows, schema))
    assert out.dtypes == spark.createDataFrame([], schema).dtypes
    assert sorted(map(tuple, out.collect())) == [(1, TEXT, "a", "b", "c", 7, None), (3, "another text", "f", "g", "h", 9, None)]
