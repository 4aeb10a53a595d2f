"""Records over several lines, split files, and tables inside tables."""

import datetime as dt

from halfhourly.sources import csvfiles as C
from halfhourly.sources.nested import nested_table_rows
from halfhourly.sources.markup import page_table_rows


def lines_of(spark, files):
    """Lines with their place, as blocks of the given sizes would hold them."""
    rows = []
    for name, text, size in files:
        at, number = 0, 0
        for line in text.split("\n"):
            rows.append((line, name, at // size * size, number, line.replace('\\"', "").count('"') % 2 == 1))
            at, number = at + len(line) + 1, number + 1
    return spark.createDataFrame(rows, f"value string, {C.SOURCE} string, _block bigint, _at bigint, _odd boolean")


def records(spark, files, **options):
    return sorted((r[C.SOURCE], r.value) for r in C.joined_lines(lines_of(spark, files), **options).collect())


def test_records_go_on_while_a_quote_is_open(spark):
    text = 'a,1\nb,"two\nlines"\nc,"x ""y""\n\nz"\nd,"whole"\ne,"p\nq","r\ns"\nf'
    want = ["a,1", 'b,"two\nlines"', 'c,"x ""y""\n\nz"', 'd,"whole"', 'e,"p\nq","r\ns"', "f"]
    for size in (1, 7, 10, 1000):       # however the file is cut into blocks
        assert records(spark, [("f", text, size)]) == sorted(("f", w) for w in want)
    both = records(spark, [("f", text, 9), ("g", text, 1000)])
    assert both == sorted((n, w) for n in "fg" for w in want)


def test_a_quote_that_is_never_closed(spark):
    text = "a,1\n" + 'b,"open\n' + "\n".join(f"c,{k}" for k in range(30))
    found = records(spark, [("f", text, 50)], most=10)
    assert found == sorted([("f", "a,1"), ("f", 'b,"open'), *[("f", f"c,{k}") for k in range(30)]])


def test_files_with_line_breaks_are_read_by_name(spark, tmp_path):
    header = 'Node,Price,"Remark",Trading Date,Trading_Period\n'
    body = "".join(f'N{k},{k}.5,"of\nnode {k}, ""so""",2014-05-0{k},{k}\n' for k in range(1, 6))
    (tmp_path / "named.csv").write_text(header + body)
    (tmp_path / "bare.csv").write_text("2014-05-09,7,N9,1.25\n2014-05-10,8,N8,x\n")
    rows = C.read_csv(spark, str(tmp_path), "nodal_prices", by_name=True)
    good = {(r.trading_date, r.trading_period, r.node, r.price) for r in C.accepted(rows).collect()}
    assert good == {(dt.date(2014, 5, k), k, f"N{k}", k + 0.5) for k in range(1, 6)} | {(dt.date(2014, 5, 9), 7, "N9", 1.25)}
    assert C.rejected(rows).count() == 1


def test_records_in_table_order(spark, tmp_path):
    (tmp_path / "f.csv").write_text('2014-05-01,1,"N\n1",2.5\n2014-05-02,2,N2,3.5\n')
    rows = C.read_csv(spark, str(tmp_path), "nodal_prices")
    assert {(r.node, r.price) for r in rows.collect()} == {("N\n1", 2.5), ("N2", 3.5)}


def test_text_is_read_once(spark, tmp_path):
    (tmp_path / "f.csv").write_text("2014-05-01,1,N1,2.5\n")
    rows = C.read_csv(spark, str(tmp_path), "nodal_prices", by_name=True)
    assert "FileScan text" not in rows._jdf.queryExecution().executedPlan().toString()


def page_rows(spark, *pages):
    df = spark.createDataFrame(list(enumerate(pages)), "page int, html string")
    return sorted([(r.page, r.table_no, r.parent_no, r.row_no, r.cells, r.reject_reason)
                   for r in nested_table_rows(df).collect()], key=repr)


def test_tables_inside_cells(spark):
    page = ("<table><tr><td>a<td>b<table><tr><td>c</td></tr><tr><td><table><tr><td>deep</table></td></tr></table>x</td></tr>"
            "<tr><td>d &amp; <i>e</i></td></tr></table><table><caption>t</caption><tr><th>f</table>")
    assert page_rows(spark, page, None, "no table") == sorted([
        (0, 0, None, 0, ["a", "b x"], None), (0, 0, None, 1, ["d & e"], None), (0, 1, 0, 0, ["c"], None),
        (0, 1, 0, 1, [""], None), (0, 2, 1, 0, ["deep"], None), (0, 3, None, 0, ["f"], None)], key=repr)


def test_malformed_tables_have_a_reason(spark):
    assert page_rows(spark, "<table><tr><td>a", "x</table>", "<table><td>a</table>", "<table><tr><td>a</td></tr>b</table>") == sorted([
        (0, 0, None, 0, ["a"], "table is not closed"), (1, 0, None, None, None, "closing tag without a table"),
        (2, 0, None, 0, ["a"], "text or cell outside of a row"), (3, 0, None, 0, ["a"], "text or cell outside of a row")], key=repr)


def test_hidden_markup_and_both_ways_of_parsing_agree(spark):
    flat = "<!-- <table> --><script>'<table>'</script><table><tr><td>a</td><td> b </td></tr></table><table><tr><td>c</td></tr></table>"
    deep = "<table><tr><td><table><tr><td>in</td></tr></table></td></tr></table><table><tr><td>c</td></tr></table>"
    df = spark.createDataFrame([(0, flat), (1, deep)], "page int, html string")
    rows = lambda n: sorted((r.page, r.row_no, r.cells) for r in page_table_rows(df, n).collect())
    assert rows(0) == [(0, 0, ["a", "b"]), (1, 0, [""])] and rows(1) == [(0, 0, ["c"]), (1, 0, ["in"])]
    assert rows(2) == [(1, 0, ["c"])]
    alone = [(r.page, r.cells) for r in nested_table_rows(df).where("page = 0").orderBy("table_no").collect()]
    assert alone == [(0, ["a", "b"]), (0, ["c"])]
