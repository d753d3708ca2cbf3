from regional_balance.operators import layout as L
from regional_balance.schema import ACTIVITIES

SCHEMA = "file string, sheet_idx int, sheet string, row int, col int, value string"
N = len(ACTIVITIES)


def sheet(file, idx, name, grid):
    return [(file, idx, name, r, c, v) for r, row in enumerate(grid) for c, v in enumerate(row)]


def fixed_grid(regions, start=100):
    titles = [["title"] + [None] * (N + 1), [None] * (N + 2), [None] * (N + 2)]
    return titles + [[str(i), r] + [str(start + i * N + a) for a in range(N)] for i, r in enumerate(regions)]


def header_grid(regions, row=2, region="County", names=None, start=500):
    head = [region] + (names or [a.upper().replace(" ", "-").replace("/", " / ") for a in ACTIVITIES])
    body = [[r] + [str(start + i * N + a) for a in range(N)] for i, r in enumerate(regions)]
    return [["note"]] * row + [head] + body


def resolve(spark, cells, **kw):
    return L.resolve_wide_layout(spark.createDataFrame(cells, SCHEMA), **kw)


def parks(df):
    return sorted((r.file, r.region_id, r["Park"], r["Snowmobiling"]) for r in df.collect())


def test_fixed_layout_wins_over_header_layout(spark):
    cells = sheet("f", 0, "Demand", header_grid(["x", "y"])) + sheet("f", 1, "other", fixed_grid(["Albany", "bronx "]))
    assert parks(resolve(spark, cells)) == [("f", "ALBANY", 100.0, 112.0), ("f", "BRONX", 113.0, 125.0)]


def test_header_layout_with_other_spellings(spark):
    cells = sheet("f", 0, "x", header_grid(["Albany", None, "nan", "Erie"], row=5))
    assert parks(resolve(spark, cells)) == [("f", "ALBANY", 500.0, 512.0), ("f", "ERIE", 539.0, 551.0)]


def test_preferred_sheet_and_first_header_row(spark):
    cells = sheet("f", 0, "aaa", header_grid(["first"])) + sheet("f", 1, " D8 ", header_grid(["second"])) + sheet("f", 2, "data", header_grid(["third"]))
    assert parks(resolve(spark, cells))[0][1] == "SECOND"
    twice = header_grid(["upper"], row=0) + header_grid(["lower"], row=0)
    got = parks(resolve(spark, sheet("g", 0, "s", twice)))
    assert [g[1] for g in got] == ["COUNTY", "LOWER", "UPPER"]


def test_unreadable_values_count_as_zero(spark):
    grid = fixed_grid(["a", "b"])
    grid[3][2], grid[4][2] = "n/a", None
    assert [p[2] for p in parks(resolve(spark, sheet("f", 0, "s", grid)))] == [0.0, 0.0]


def test_fixed_layout_needs_width_rows_and_a_region(spark):
    narrow = [row[:-1] for row in fixed_grid(["a", "b"])]
    short = fixed_grid(["a"])
    blank = fixed_grid([None, None])
    cells = sheet("narrow", 0, "s", narrow) + sheet("short", 0, "s", short) + sheet("blank", 0, "s", blank)
    df = spark.createDataFrame(cells, SCHEMA)
    assert L.find_layouts(df).count() == 0
    assert sorted(r.file for r in L.unresolved_files(df).collect()) == ["blank", "narrow", "short"]


def test_header_needs_every_activity_and_a_filled_region_column(spark):
    missing = header_grid(["a"], names=list(ACTIVITIES[:-1]) + ["Polo"])
    empty = header_grid(["", None])
    late = header_grid(["a"], row=15)
    cells = sheet("missing", 0, "s", missing) + sheet("empty", 0, "s", empty) + sheet("late", 0, "s", late)
    assert L.find_layouts(spark.createDataFrame(cells, SCHEMA)).count() == 0


def test_region_column_fallback_and_repeated_headers(spark):
    fallback = header_grid(["a"], region="Place")
    unnamed = [r + ["extra"] for r in header_grid(["a"], region="Unnamed: 0")]
    unnamed[2][-1] = "Zone"
    named = [["x"] + r for r in header_grid(["a"])]
    named[2][0] = "Place"
    repeated = [r + ["999"] for r in header_grid(["a"], names=list(ACTIVITIES))]
    repeated[2][-1] = "Park"
    cells = []
    for file, grid in {"fallback": fallback, "unnamed": unnamed, "named": named, "repeated": repeated}.items():
        cells += sheet(file, 0, "s", grid)
    got = {f: (r, p) for f, r, p, _ in parks(resolve(spark, cells))}
    assert got == {"fallback": ("A", 500.0), "unnamed": ("EXTRA", 500.0), "named": ("A", 500.0), "repeated": ("A", 500.0)}


def test_exact_name_before_spelling_key(spark):
    grid = [["County", "court_games", "Court Games"], ["a", "1", "2"]]
    got = resolve(spark, sheet("f", 0, "s", grid), activities=["Court Games"]).collect()
    assert got[0]["Court Games"] == 2.0


def test_cells_from_csv(spark, tmp_path):
    lines = ["title", "", '"County, name",Park', '"Erie ""N""",5', "Kings,"]
    (tmp_path / "d8.csv").write_text("\r\n".join(lines))
    cells = L.cells_from_csv(spark, str(tmp_path))
    got = {(r.row, r.col): r.value for r in cells.collect()}
    assert got == {(0, 0): "title", (2, 0): "County, name", (2, 1): "Park", (3, 0): 'Erie "N"', (3, 1): "5", (4, 0): "Kings", (4, 1): None}
    table = L.resolve_wide_layout(cells, ["Park"]).collect()
    assert sorted((r.region_id, r.Park) for r in table) == [('ERIE "N"', 5.0), ("KINGS", 0.0)]


def test_no_row_gathering_in_the_plan(spark, plan):
    text = plan(resolve(spark, sheet("f", 0, "s", fixed_grid(["a", "b"]))))
    assert "collect_" not in text and "Python" not in text


def test_header_far_down_is_found_without_a_bound(spark):
    from regional_balance.operators import layout as L

    cells = [("f", 0, "Sheet1", 20, 0, "Region"), ("f", 0, "Sheet1", 20, 1, "Park"), ("f", 0, "Sheet1", 21, 0, "Kent"), ("f", 0, "Sheet1", 21, 1, "4")]
    df = spark.createDataFrame(cells, "file string, sheet_idx int, sheet string, row int, col int, value string")
    assert L.unresolved_files(df, ["Park"]).count() == 1
    row = L.resolve_wide_layout(df, ["Park"], L.LayoutRules(header_rows=None)).first()
    assert (row.region_id, row.Park) == ("KENT", 4.0)
