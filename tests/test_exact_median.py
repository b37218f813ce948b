import statistics

from tagwise.operators import metrics


def test_middle_values_in_two_bins_need_no_window(spark, monkeypatch):
    monkeypatch.setattr(metrics, "Window", None)
    low, high = [0.1 + i / 1000 for i in range(20)], [0.9 - i / 1000 for i in range(20)]
    df = spark.createDataFrame([(x,) for x in low + high] + [(None,)], "p double")
    assert metrics.exact_median(df, "p") == statistics.median(low + high)
    # the bins are split in the second round
    df = spark.createDataFrame([(0.5,), (0.5 + 1e-5,)], "p double")
    assert metrics.exact_median(df, "p") == statistics.median([0.5, 0.5 + 1e-5])
