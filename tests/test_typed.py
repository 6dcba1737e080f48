"""INFO by the header's types: parsing, splits by Number, merges, headers with differing types."""

from pyspark.sql import functions as F

from genoframe.sources import genomic as G
from genoframe.sources import typed as Y

HEADER = ["AF,Number=A,Type=Float", "AD,Number=R,Type=Integer", "PL,Number=G,Type=Integer", "DP,Number=1,Type=Integer", "DB,Number=0,Type=Flag", "CSQ,Number=.,Type=String"]


def _header(spark, items):
    return G.parse_header(spark.createDataFrame([(f'##INFO=<ID={x},Description="d">',) for x in items], "value string"))


def _records(spark, *infos):
    return G.parse_vcf(spark.createDataFrame([(f"1\t{i}\t.\tA\t{alt}\t.\tPASS\t{info}",) for i, (alt, info) in enumerate(infos)], "value string"))


def test_split_by_number(spark):
    fields = Y.declared(_header(spark, HEADER))
    rows = _records(spark, ("C,G", "AF=0.5,.;AD=9,3,4;PL=0,1,2,3,4,5;DP=12;DB;CSQ=a,b;XX=1"), ("T", "AF=x;AD=.;DP=."), ("T", "."))
    out = [(r.pos, r.alt, *[r.fields[k] for k in ("AF", "AD", "PL", "DP", "DB", "CSQ")]) for r in Y.split_by_header(Y.typed_info(rows, fields), fields).orderBy("pos", "alt").collect()]
    assert out[:2] == [(0, "C", [0.5], [9, 3], [0, 1, 2], 12, True, ["a", "b"]), (0, "G", [None], [9, 4], [0, 3, 5], 12, True, ["a", "b"])]
    assert out[2:] == [(1, "T", [None], None, None, None, False, None), (2, "T", None, None, None, None, False, None)]
    assert Y.split_by_header(Y.typed_info(rows.filter("false"), fields), fields).count() == 0


def test_merge_by_type(spark):
    """Headers that differ in Number and Type are read by the merged one; the merge follows it, and a rule goes before it."""
    other = ["AF,Number=1,Type=Float", "DP,Number=1,Type=Float", "DB,Number=0,Type=Flag", "CSQ,Number=1,Type=Integer", "NEW,Number=1,Type=String"]
    merged = G.merged_headers(_header(spark, HEADER), _header(spark, other))
    fields = Y.declared(merged)
    told = {f.id: (f.number, f.type) for f in fields}
    assert (told["AF"], told["DP"], told["CSQ"], told["NEW"], told["DB"]) == ((".", "Float"), ("1", "Float"), (".", "String"), ("1", "String"), ("0", "Flag"))
    a = Y.typed_info(_records(spark, ("C", "AF=0.1,0.2;DP=4;CSQ=x")), fields).select(F.col("fields").alias("a"))
    b = Y.typed_info(_records(spark, ("C", "AF=0.3;DP=5.5;DB;CSQ=7;NEW=n")), fields).select(F.col("fields").alias("b"))
    both = a.crossJoin(b)  # one row each
    r = both.select(Y.merged_fields(F.col("a"), F.col("b"), fields).alias("m"), Y.merged_fields(F.col("a"), F.col("b"), fields, {"DP": lambda x, y: x + y}).alias("n")).head()
    assert (r.m.AF, r.m.DP, r.m.DB, r.m.CSQ, r.m.NEW, r.m.AD, r.n.DP) == ([0.1, 0.2, 0.3], 4.0, True, ["x", "7"], "n", None, 9.5)
