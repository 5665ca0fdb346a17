"""File front end over hand-written landing folders (one file per case)."""

import os
from decimal import Decimal as D

import pytest
from pyspark.sql import functions as F

from tillroll.plans import batch
from tillroll.sinks.quarantine import quarantine
from tillroll.sources.files import file_headers, file_manifest

HDR = "customer_id,store_id,product_name,sales_date,sales_person_id,price,quantity,total_cost"
ROW = "1,121,sugar,2023-03-03,1,50,2,100"

CASES = {
    "good.csv": [HDR, ROW, "2,122,besan,2023-03-04,4,52,1,52"],
    "a_good.csv": [HDR, "3,123,maida,2023-03-05,7,20,3,60"],  # name is a suffix-match trap
    "extra.csv": [HDR + ",payment_mode,note", ROW + ",cash,", ROW + ",,"],
    "reordered.csv": ["store_id,customer_id,product_name,sales_date,sales_person_id,price,"
                      "quantity,total_cost", "122,5,sugar,2023-03-06,4,50,1,50"],
    "quoted.csv": ['"customer_id","store_id","product_name","sales_date","sales_person_id",'
                   '"price","quantity","total_cost"', '6,121,"refined oil, 1l",2023-03-07,2,110,1,110'],
    "missing.csv": ["customer_id,product_name,sales_date,sales_person_id,price,quantity,"
                    "total_cost,payment_mode", '1,sugar,2023-03-03,"[1, 2, 3]",50,2,100,UPI'],
    "bad_date.csv": [HDR, "7,121,sugar,03/03/2023,1,50,2,100", "8,121,sugar,2023-03-08,1,50,2,100"],
    "header_only.csv": [HDR],
    "empty.csv": [],
    "notes.txt": ["not a sales file"],
    "own_additional.csv": [HDR + ",additional_column", ROW + ",old"],
    "case_dup.csv": [HDR + ",Price", ROW + ",9"],
    "blank_name.csv": [HDR + ",,note", ROW + ",x,y"],
    "underscore_extra.csv": [HDR + ",_note,we`ird", ROW + ",n,w"],
    "leading_blank.csv": ["", "  ", HDR, ROW],
    "trailing_comma.csv": [HDR + ",", ROW + ",t"],
    "space_name.csv": [HDR.replace(",price", ", price"), ROW],
    "UPPER.CSV": [HDR, ROW],
    "_hidden.csv": [HDR, ROW],
    ".dot.csv": [HDR, ROW],
    "wide_quoted.csv": [",".join(f'"q{i}, x"' for i in range(20_000)), "1"],
    "one_long_line.csv": ["x" * 10_000_000],
    "long_quotes.csv": ['"' + '""' * 50_000 + '"', "1"],
    "quote_in_value.csv": [HDR, '1,121,"2"" pipe",2023-03-03,1,50,2,100'],
    "ragged.csv": [HDR, "9,121,sugar,2023-03-03,1,50,2,100,EXTRA", "9,121,sugar,2023-03-03,1,50"],
    "reserved.csv": [HDR + ",_corrupt_record", ROW + ",x"],
}


@pytest.fixture()
def landing(tmp):
    root = os.path.join(tmp, "landing")
    os.makedirs(os.path.join(root, "day2"))
    for name, lines in CASES.items():
        sub = "day2" if name == "a_good.csv" else ""
        with open(os.path.join(root, sub, name), "w") as fh:
            fh.write("".join(line + "\n" for line in lines))
    return root


def test_crlf_and_bom_files(spark, tmp):
    root = os.path.join(tmp, "win")
    os.makedirs(root)
    with open(os.path.join(root, "crlf.csv"), "wb") as fh:
        fh.write((HDR + "\r\n" + ROW + "\r\n").encode())
    with open(os.path.join(root, "bom.csv"), "wb") as fh:
        fh.write(b"\xef\xbb\xbf" + (HDR + "\n" + ROW + "\n").encode())
    for method in ("text", "first_bytes"):
        ing = batch.ingest(spark, root, header_method=method)
        routed = {r.file_name: r for r in ing.routed.collect()}
        assert routed["crlf.csv"].ok, routed["crlf.csv"].reason
        assert routed["bom.csv"].ok, routed["bom.csv"].reason
        acc = ing.read.accepted.collect()
        assert sorted((r.customer_id, r.total_cost) for r in acc) == [(1, D("100.00"))] * 2


def _by_name(df):
    return {r.file_name: r for r in df.collect()}


def test_manifest_routes_by_extension(spark, landing):
    m = _by_name(file_manifest(spark, landing))
    # Zero-byte files and hidden names, which Spark's readers skip, are listed too.
    assert set(m) == set(CASES)
    assert not m["notes.txt"].is_csv and m["good.csv"].is_csv and not m["UPPER.CSV"].is_csv
    assert m["empty.csv"].length == 0 and m["_hidden.csv"].length > 0
    assert all(r.modification_time is not None for r in m.values())


def test_headers_one_row_per_nonempty_file(spark, landing):
    h = {os.path.basename(r.file_path): r for r in
         file_headers(spark, landing, path_glob="*.csv", recursive=True).collect()}
    assert "empty.csv" not in h
    assert h["good.csv"].header_line == HDR and h["good.csv"].n_lines == 3
    assert h["header_only.csv"].n_lines == 1


def test_routes_and_reasons(spark, landing):
    ing = batch.ingest(spark, landing)
    r = _by_name(ing.routed)
    assert r["missing.csv"].reason == "missing:store_id"
    assert list(r["missing.csv"].missing) == ["store_id"]
    assert r["empty.csv"].reason == "empty"
    assert r["notes.txt"].reason == "not_csv" and r["UPPER.CSV"].reason == "not_csv"
    assert r["_hidden.csv"].reason == "hidden" and r[".dot.csv"].reason == "hidden"
    assert r["space_name.csv"].reason == "missing:price"  # names are not trimmed
    assert all(r[x].reason.startswith("missing:") for x in ("wide_quoted.csv", "one_long_line.csv", "long_quotes.csv"))
    assert list(r["blank_name.csv"].extra) == ["_c8", "note"] and list(r["trailing_comma.csv"].extra) == ["_c8"]
    assert list(r["extra.csv"].extra) == ["payment_mode", "note"]
    assert r["case_dup.csv"].reason == "duplicate_columns"
    assert r["reserved.csv"].reason == "reserved_column_name"
    ok = {k for k, v in r.items() if v.ok}
    assert ok == {"good.csv", "a_good.csv", "extra.csv", "reordered.csv", "quoted.csv",
                  "bad_date.csv", "header_only.csv", "own_additional.csv", "ragged.csv", "blank_name.csv",
                  "underscore_extra.csv", "leading_blank.csv", "trailing_comma.csv", "quote_in_value.csv"}
    # plain (also quoted, leading blank), extra, reordered, own additional, blank name, underscore, trailing comma
    assert ing.read.layouts == 7


def test_accepted_rows_conformed_by_name(spark, landing):
    ing = batch.ingest(spark, landing)
    rows = ing.read.accepted.collect()
    acc = {(r.customer_id, r._src_file.rsplit("/", 1)[-1]): r for r in rows}
    # reordered header: values land in the right columns
    r = acc[(5, "reordered.csv")]
    assert (r.store_id, r.sales_person_id, r.total_cost) == (122, 4, D("50.00"))
    # quoted header and a quoted comma in a value
    assert acc[(6, "quoted.csv")].product_name == "refined oil, 1l"
    # extras folded in header order; nulls skipped; all-null gives ''
    extra = sorted(r.additional_column for r in rows if r._src_file.endswith("/extra.csv"))
    assert extra == ["", "cash"]
    assert acc[(1, "good.csv")].additional_column is None
    # a source column named additional_column is an extra and is replaced
    assert acc[(1, "own_additional.csv")].additional_column == "old"
    assert acc[(1, "underscore_extra.csv")].additional_column == "n,w"
    assert acc[(1, "blank_name.csv")].additional_column == "x,y"
    assert acc[(1, "trailing_comma.csv")].additional_column == "t"
    assert acc[(1, "leading_blank.csv")].total_cost == D("100.00")
    assert acc[(1, "quote_in_value.csv")].product_name == '2" pipe'
    assert acc[(8, "bad_date.csv")].sales_date.isoformat() == "2023-03-08"


def test_rejects_and_row_invariant(spark, landing):
    ing = batch.ingest(spark, landing)
    rej = ing.read.rejects.collect()
    assert sorted((os.path.basename(r.file_path), r.raw_line) for r in rej) == [
        ("bad_date.csv", "7,121,sugar,03/03/2023,1,50,2,100"),
        ("ragged.csv", "9,121,sugar,2023-03-03,1,50"),
        ("ragged.csv", "9,121,sugar,2023-03-03,1,50,2,100,EXTRA")]
    files, lines = quarantine(spark, ing.routed)
    read = {k: [x for x in v if x.strip()] for k, v in CASES.items() if k.endswith(".csv") and k[0] not in "_."}
    data_lines_in = sum(max(len(v) - 1, 0) for v in read.values())
    q_rows = lines.count() - lines.select("file_path").distinct().count()
    assert ing.read.accepted.count() + len(rej) + q_rows == data_lines_in
    assert {r.file_name for r in files.collect()} == SET_ASIDE


SET_ASIDE = {"missing.csv", "notes.txt", "case_dup.csv", "reserved.csv", "empty.csv", "UPPER.CSV", "_hidden.csv", ".dot.csv",
             "space_name.csv", "wide_quoted.csv", "one_long_line.csv", "long_quotes.csv"}


def test_split_does_not_depend_on_a_cache(spark, landing):
    ing = batch.ingest(spark, landing)
    rows = ing.read.accepted.agg(F.sum("total_cost"), F.count("*")).first()
    bad = ing.read.rejects.count()
    spark.catalog.clearCache()
    assert ing.read.accepted.agg(F.sum("total_cost"), F.count("*")).first() == rows
    assert ing.read.accepted.select("customer_id").count() == rows[1] and ing.read.rejects.count() == bad == 3


def test_accepted_file_with_very_many_columns(spark, tmp):
    root = os.path.join(tmp, "wide")
    os.makedirs(root)
    with open(os.path.join(root, "w.csv"), "w") as fh:
        fh.write(HDR + "".join(f',"x{i}"' for i in range(3000)) + "\n" + ROW + ",v" * 3000 + "\n")
    row = batch.ingest(spark, root).read.accepted.first()
    assert row.total_cost == D("100.00") and row.additional_column == ",".join(["v"] * 3000)


def test_money_is_rounded_half_up_to_cents(spark, tmp):
    root = os.path.join(tmp, "cents")
    os.makedirs(root)
    with open(os.path.join(root, "m.csv"), "w") as fh:
        fh.write(HDR + "\n1,121,sugar,2023-03-03,1,50,2,1.555\n")
    assert batch.ingest(spark, root).read.accepted.first().total_cost == D("1.56")


def test_reads_folders_where_their_files_agree(spark, tmp):
    from tillroll.sources.sales_csv import layout_folders

    root = os.path.join(tmp, "folders")
    for name, lines in {"same/a.csv": [HDR, ROW], "same/b.csv": [HDR, ROW], "same/x.txt": ["n"], "mixed/a.csv": [HDR, ROW], "mixed/b.csv": ["x", "1"],
                        "above/a.csv": [HDR, ROW], "above/k=1/b.csv": [HDR, ROW]}.items():
        os.makedirs(os.path.dirname(os.path.join(root, name)), exist_ok=True)
        with open(os.path.join(root, name), "w") as fh:
            fh.write("".join(x + "\n" for x in lines))
    _, routed = batch.route(spark, root)
    whole, mixed = layout_folders(routed)
    (paths,) = whole.values()
    assert [[p.split("folders/")[1] for p in x] for x in (paths, mixed)] == [["above/k=1", "same"], ["above", "mixed"]]
    assert batch.ingest(spark, root).read.accepted.count() == 5


def test_quarantine_writes_tables(spark, landing, tmp):
    ing = batch.ingest(spark, landing)
    out = os.path.join(tmp, "q")
    quarantine(spark, ing.routed, out=out, run_id="r1")
    lines = spark.read.parquet(out + "/lines")
    assert lines.filter(F.col("reason") == "missing:store_id").count() == 2
    assert spark.read.parquet(out + "/files").count() == len(SET_ASIDE)


def test_first_bytes_headers_match_text_scan(spark, landing):
    from tillroll.sources.files import file_headers_first_bytes

    text = {r.file_path: r.header_line for r in
            file_headers(spark, landing, path_glob="*.csv", recursive=True).collect()}
    fast = {r.file_path: r.header_line for r in
            file_headers_first_bytes(file_manifest(spark, landing)).collect()}
    assert fast == text
    a = batch.ingest(spark, landing, header_method="text")
    b = batch.ingest(spark, landing, header_method="first_bytes")
    key = ["file_name", "ok", "reason"]
    assert sorted(a.routed.select(key).collect()) == sorted(b.routed.select(key).collect())
    assert a.read.accepted.exceptAll(b.read.accepted).count() == 0


def test_special_characters_in_paths(spark, tmp):
    root = os.path.join(tmp, "odd names", "day+1")
    os.makedirs(root)
    good = os.path.join(root, "a b%20c+d[1].csv")
    bad = os.path.join(root, "bad file+1{x}.csv")
    with open(good, "w") as fh:
        fh.write(HDR + "\n" + ROW + "\n")
    with open(bad, "w") as fh:
        fh.write("customer_id,price\n1,2\n3,4\n")
    for method in ("text", "first_bytes"):
        ing = batch.ingest(spark, os.path.join(tmp, "odd names"), header_method=method)
        routed = {r.file_name: r for r in ing.routed.collect()}
        assert routed["a b%20c+d[1].csv"].ok
        assert routed["bad file+1{x}.csv"].reason.startswith("missing:")
        src = {r._src_file for r in ing.read.accepted.collect()}
        assert src == {routed["a b%20c+d[1].csv"].file_path}
        files, lines = quarantine(spark, ing.routed)
        assert lines.count() == 3
