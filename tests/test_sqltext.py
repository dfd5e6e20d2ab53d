from weekshare.functions.sqltext import ident, in_list, lit
from weekshare.functions.text import UNICODE_WHITE_SPACE


def test_literals_round_trip_through_spark(spark):
    values = ["O'Hare", "back\\slash", "tab\tand\nnewline", "Año ñ €", "", UNICODE_WHITE_SPACE, "%_"]
    row = spark.range(1).selectExpr(*[f"{lit(v)} AS c{i}" for i, v in enumerate(values)]).first()
    assert list(row) == values
    row = spark.range(1).selectExpr(f"{lit(None)} IS NULL AS a", f"{lit(3)} AS b", f"{lit(2.5)} AS c",
                                    f"{lit(True)} AS d", f"{lit(2**40)} AS e").first()
    assert tuple(row) == (True, 3, 2.5, True, 2**40)


def test_identifiers_and_lists(spark):
    df = spark.createDataFrame([("x",)], "`we``ird col` string")
    assert df.selectExpr(f"{ident('we`ird col')} IN {in_list(['x', 'y'])} AS ok").first().ok
