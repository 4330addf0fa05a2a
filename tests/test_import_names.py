"""Names of everything a file refers to, however many they are."""

from symbolweave.catalog import QUERIES


def test_import_names_holds_the_names_of_a_file_with_more_than_fifty(spark, tmp_path):
    write = lambda name, fields, made: spark.createDataFrame(made, fields).write.parquet(f"{tmp_path}/{name}.parquet")
    names = [f"n{i:02d}" for i in range(60)]
    write("part", "p_partkey long, p_name string, p_brand string, p_type string, p_size int", [
        (10 * i + 1, name, "B#1", "T", 1) for i, name in enumerate(names)])
    write("orders", "o_orderkey long, o_custkey long, o_orderpriority string, o_orderstatus string", [(1, 5, "1-URGENT", "F")])
    write("lineitem", "l_orderkey long, l_linenumber int, l_partkey long, l_returnflag string, l_linestatus string", [
        (1, i % 7 + 1, 10 * i + 1, "A", "F") for i in range(60)])
    found = QUERIES["import_names"](spark, str(tmp_path)).collect()
    assert [r["names"] for r in found] == [", ".join(names)]
