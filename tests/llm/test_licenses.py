from pathlib import Path

import pytest

from dayfacts.llm import licenses as L

INSTALLED = Path("/usr/share/common-licenses")


def scan(spark, *texts):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    return {r.doc_id: r for r in L.scan_licenses(docs, L.known_digests(spark)).collect()}


def test_whole_texts_in_other_dress(spark):
    mit = next(t for n, _, t in L.KNOWN if n == "MIT" and len(t) > 500)
    apache = next(t for n, _, t in L.KNOWN if n == "Apache-2.0" and len(t) > 200)
    bsd = next(t for n, _, t in L.KNOWN if n == "BSD-3-Clause")
    got = scan(
        spark,
        mit,
        "Copyright (c) 2020 Some One\nAll rights reserved.\n\n" + mit.upper().replace(" ", "   "),
        mit.replace("sublicense", "sub-license").replace('"', "'").replace(". ", ".\n"),
        apache.replace("License", "Licence").replace("http://", "https://"),
        bsd.replace("copyright holder", "copyright owner"),
        mit + " More text.",
        mit[:-40],
        bsd.replace("copyright holder", "copyright\nowner"),
        "The MIT License (MIT)\n\nCopyright (c) 2024 X\n\n" + mit.replace(", ", ",\n"),
        "BSD 3-Clause License\n\nCopyright 2001, Y\nAll rights reserved.\n\n" + bsd,
    )
    assert [got[i].text_license for i in range(10)] == ["MIT", "MIT", "MIT", "Apache-2.0", "BSD-3-Clause", None, None, "BSD-3-Clause", "MIT", "BSD-3-Clause"]
    assert got[0].text_class == "permissive"


def test_whole_lines(spark):
    got = scan(spark, "Text here.\n  LICENCED under the mit licence \nmore", "Licensed under the Apache License, Version 2.0!\n# Licensed under CC BY-NC 4.0.\nLicensed under CC BY-NC 4.0", "It is licensed under the MIT License.")
    assert [(got[i].line_licenses, got[i].n_license_lines, got[i].n_lines) for i in range(3)] == [("MIT", 1, 3), ("Apache-2.0,CC-BY-NC-4.0", 3, 3), ("", 0, 1)]
    (row,) = scan(spark, "Licensed under the MIT Licence").values()
    assert (row.line_licenses, row.text_license) == ("MIT", "MIT")


def test_a_wrapped_notice_is_no_copyright_line(spark):
    (row,) = scan(spark, "The above\ncopyright notice and more\nCopyright 1999 X\n(c) 2001\n© Y").values()
    assert row.n_lines == 2


def test_known_digests_are_one_row_each(spark):
    known = L.known_digests(spark)
    assert known.count() == known.select("digest").distinct().count() == len(L.known_texts()) + len(L.FULL_TEXTS)


def test_awkward_documents(spark, awkward):
    out = L.scan_licenses(awkward, L.known_digests(spark))
    rows = {r.doc_id: r for r in out.collect()}
    assert out.count() == awkward.count()
    assert set(rows) == {1, 2, 3, 4, None, 5, 6, 7} and rows[1].n_lines == 1 and rows[2].n_lines == rows[3].n_lines == rows[4].n_lines == 0
    assert rows[2].line_licenses == "" and rows[2].text_license is None
    assert L.scan_licenses(awkward.limit(0), L.known_digests(spark)).count() == 0
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_texts_of_a_folder(spark, tmp_path):
    (tmp_path / "Long-1.0.txt").write_text("The long licence.\n\nIt has  paragraphs.\n")
    known = L.known_digests(spark, folder=str(tmp_path))
    docs = spark.createDataFrame([(1, "the LONG license\n\nit has paragraphs"), (2, "the long")], "doc_id long, text string")
    assert {r.doc_id: (r.text_license, r.text_class) for r in L.scan_licenses(docs, known).collect()} == {1: ("Long-1.0", "full text"), 2: (None, None)}


def test_full_texts_as_installed(spark):
    files = {name: INSTALLED / name.removesuffix("-1.0" if name.startswith("Artistic") else ".0" if "GPL" in name else "-") for name, *_ in L.FULL_TEXTS}
    files = {name: path.read_text() for name, path in files.items() if path.is_file()}
    if not files:
        pytest.skip("no licence texts are installed here")
    got = scan(spark, *files.values(), *["(c) 2024 X\n\n" + t.upper().replace("\n", " \n") for t in files.values()])
    assert [got[i].text_license for i in range(2 * len(files))] == [*files, *files]


def test_possible_lengths():
    assert L.possible_lengths([12, 16, 120]) == [(9, 21), (90, 160)]
    assert L.possible_lengths([]) == []
