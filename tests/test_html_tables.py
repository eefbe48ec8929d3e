"""HTML tables with nesting and omitted end tags: golden pages, and random tag sequences against a plain tree builder."""

import random
import re

from noticespark.functions import text as T
from noticespark.operators.aggregates import products_from_tables
from pyspark.sql import functions as F

GOLDEN = {
    "<table><tr><td>1234.56.7890</td><td><table><tr><td>in<b>ner</b> x</td></tr></table> tail</td></tr><tr><td>9999.11.2222<td>unclosed</tr></table><p>z":
        [[["1234.56.7890", "innerxtail", "innerx"], ["innerx"], ["9999.11.2222", "unclosed"]], [["innerx"]]],
    "<table><tr><th>A<th>B<tr><td>1<td>2</table><table><tr><td>c": [[["A", "B"], ["1", "2"]], [["c"]]],
    "<TABLE class=x><thead><tr><th>h</th></tr><tbody><tr><td> a &amp; b </td></tr><tr></tr></tbody></table><table></table>": [[["h"], ["a & b"]]],
    "<table><tr><td>o<table><tr><td>i</td></td></tr></table>rest</td><td>p</td></tr></table>": [[["oirest", "i", "p"], ["i"]], [["i"]]],
    "<td>alone</td><tr><td>no table</td></tr>": [], "": [], "<table>": [], "<table><td>no row</td></table>": [],
    "<table><tr><td>a<!-- <td>b --><script><td>c</script></td></tr></table>": [[["a"]]],
    "<table><tr><td>1<table><tr><td>2<table><tr><td>3</table></table>4</table>": [[["1234", "23", "3"], ["23", "3"], ["3"]], [["23", "3"], ["3"]], [["3"]]],
}


def tables_of(spark, pages):
    rows = [(i, h) for i, h in enumerate(pages)]
    df = spark.createDataFrame(rows, "i int, h string").select("i", T.html_tables(F.col("h")).alias("t"))
    return [r.t for r in df.orderBy("i").collect()]


def test_golden_tables(spark):
    assert tables_of(spark, [*GOLDEN, None]) == [*GOLDEN.values(), []]


def test_products_of_nested_and_unclosed_rows(spark):
    page = next(iter(GOLDEN))
    df = spark.createDataFrame([(1, page)], "k int, h string").select("k", T.html_tables(F.col("h")).alias("tables"))
    found = {(r.t_idx, r.r_idx): r.hts_codes for r in products_from_tables(df, "k", "tables").collect()}
    assert found == {(0, 0): ["1234.56.0000", "1234.56.7890"], (0, 2): ["9999.11.0000", "9999.11.2222"]}


class Element:
    def __init__(self, name):
        self.name, self.parts = name, []

    def below(self, names):
        for p in self.parts:
            if isinstance(p, Element):
                if p.name in names:
                    yield p
                yield from p.below(names)

    def text(self):
        return "".join(p.text() if isinstance(p, Element) else p.strip() for p in self.parts)


def plain_tables(page):
    """A tree built tag by tag, walked for tables, rows and cells."""
    implied = {"td": "td th", "th": "td th", "tr": "td th tr", "tbody": "td th tr thead tbody tfoot", "tfoot": "td th tr thead tbody"}
    rank = {"td": 1, "th": 1, "tr": 2, "thead": 3, "tbody": 3, "tfoot": 3, "table": 4, "": 9}
    stack = [Element("")]
    for piece in re.split(r"(</?(?:table|thead|tbody|tfoot|tr|td|th)>)", page):
        if not piece.startswith("<"):
            stack[-1].parts.append(piece)
        elif piece.startswith("</"):
            name = piece[2:-1]
            above = [e.name for e in reversed(stack)]
            if name in above and all(rank[n] <= rank[name] for n in above[:above.index(name)]):
                del stack[len(stack) - above.index(name) - 1:]
        else:
            name = piece[1:-1]
            while stack[-1].name and stack[-1].name in implied.get(name, "").split():
                stack.pop()
            new = Element(name)
            stack[-1].parts.append(new)
            stack.append(new)
    tables = []
    for table in stack[0].below(["table"]):
        rows = [[c.text() for c in row.below(["td", "th"])] for row in table.below(["tr"])]
        if any(rows):
            tables.append([r for r in rows if r])
    return tables


def test_random_tags_equal_plain_tree(spark):
    rnd = random.Random(7)
    tags = ["<table>", "</table>", "<tr>", "</tr>", "<td>", "</td>", "<th>", "</th>", "<tbody>", "</tbody>", "<thead>", "</thead>", "<tfoot>", " a ", "b"]
    pages = ["".join(rnd.choices(tags, weights=[3, 2, 5, 3, 6, 4, 2, 1, 1, 1, 1, 1, 1, 6, 6], k=rnd.randint(0, 60))) for _ in range(400)]
    found = tables_of(spark, pages)
    for page, tables in zip(pages, found):
        assert tables == plain_tables(page), page
    assert sum(map(bool, found)) > 100


def test_long_table(spark):
    rows = 3_000
    page = "<table>" + "".join(f"<tr><td>{i}<td>x" for i in range(rows)) + "</table>"
    assert tables_of(spark, [page]) == [[[[str(i), "x"] for i in range(rows)]]]
