import __spark_entry__ as entry_mod


def test_entry_smoke(spark):
    df = entry_mod.entry(spark)
    assert df.columns == ["TotalUnitSold", "TotalRevenueGenerated", "TotalNumberOfTransactions",
                          "AverageRevenueGenerated", "TotalFootwearRevenue", "NumberOfHVTransaction",
                          "TotalLocalRevenue", "Calendar_Key", "Store_Key"]
    assert df.count() == 1380
