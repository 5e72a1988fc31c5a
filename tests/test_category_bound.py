"""Categories beyond the bound are an error, never left out."""

import pytest

from kanaat.plans import sources


def test_too_many_categories(spark, tmp_path):
    rows = [(i, f"l{i}", "web") for i in range(sources.MOST_CATEGORIES + 1)]
    spark.createDataFrame(rows, "doc_id long, lang string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    with pytest.raises(ValueError, match="more than 1000 categories"):
        sources.first_file_per_category(spark, str(tmp_path))
