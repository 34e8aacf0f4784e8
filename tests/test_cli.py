"""The command line on folders of small documents, and its exit codes."""

import json

import pytest

from glyphweave import cli
from glyphweave.operators import preflight
from glyphweave.sources import docx, pages

pytestmark = pytest.mark.usefixtures("small_plans")
OPENING = "بِسمِ اللهِ الرحمنِ الرحيمِ"


def write(folder, **texts):
    folder.mkdir(exist_ok=True)
    for name, lines in texts.items():
        runs = [[{"text": t, "fonts": dict.fromkeys(docx.SLOTS, docx.TARGET_FONT)}] for t in lines]
        (folder / f"{name}.docx").write_bytes(docx.new_document(runs))


def test_filter_writes_outputs_and_reports(spark, tmp_path):
    source, out, reports = tmp_path / "in", tmp_path / "out", tmp_path / "reports"
    write(source, one=[OPENING, "ب۝ت"])
    args = ["--output-dir", str(out), "--report-dir", str(reports)]
    assert cli.main(["filter", str(tmp_path / "none"), *args], spark) == cli.ARGUMENT
    assert cli.main(["filter", str(source), *args], spark) == cli.OK
    written = (out / "one.filtered.docx").read_bytes()
    texts = [r.text for r in docx.paragraphs(spark.createDataFrame([("x", bytearray(written))], "path string, content binary")).orderBy("paragraph").collect()]
    assert texts[1] == "ب ت"
    audit = json.loads((reports / "one.audit.json").read_text())
    assert audit["passed"] and audit["identity"] == "Al-Fatihah" and audit["word_boundary_repairs"] == 1
    assert "C8_word_boundary_repair" in (reports / "one.audit.md").read_text() and "PASS" in (reports / "one.preflight.md").read_text()
    assert json.loads((reports / "combined.audit.json").read_text())["visual_qa_complete"] is False
    assert cli.main(["filter", str(source), *args], spark) == cli.EXISTS
    assert cli.main(["review", "--report-dir", str(reports), "--status", "pass", "--notes", "looked at"], spark) == cli.OK
    assert json.loads((reports / "combined.audit.json").read_text())["visual_qa_complete"] is True
    assert "one.audit.json" in (reports / "combined.audit.md").read_text() or "Al-Fatihah" in (reports / "combined.audit.md").read_text()


def test_batch_gives_each_document_its_code(spark, tmp_path):
    source = tmp_path / "in"
    write(source, one=[OPENING], two=["ب"])
    (source / "sub").mkdir()
    args = [str(source), str(tmp_path / "out"), "--report-dir", str(tmp_path / "r"), "--audit-only"]
    assert cli.main(["batch", *args], spark) == cli.PARTIAL
    assert json.loads((tmp_path / "r" / "two.preflight.json").read_text())["identity"] == preflight.UNIDENTIFIED and not (tmp_path / "out").exists()
    write(source / "sub", one=[OPENING])
    assert cli.main(["batch", *args, "--recursive"], spark) == cli.ARGUMENT


def test_normalise_concat_typeset_extract(spark, tmp_path, capsys):
    assert cli.main(["normalise", "--self-test"], spark) == cli.OK
    source = tmp_path / "in"
    write(source, **{"1 a": ["الٓمٓ"], "2 b": ["كلمة", "في"]})
    assert cli.main(["normalise", str(source), str(tmp_path / "out")], spark) == cli.OK
    assert "2 of 2 documents" in capsys.readouterr().out
    assert cli.main(["normalise", str(source), str(tmp_path / "out")], spark) == cli.EXISTS
    assert cli.main(["concat", str(source), str(tmp_path / "all.docx"), "--last", "3"], spark) == cli.ARGUMENT
    assert cli.main(["concat", str(source), str(tmp_path / "all.docx"), "--last", "2"], spark) == cli.OK
    joined = spark.createDataFrame([("x", bytearray((tmp_path / "all.docx").read_bytes()))], "path string, content binary")
    assert docx.paragraphs(joined).first().text == "001 . الٓمٓ . 002 . كلمة في ."
    assert cli.main(["typeset", str(source), str(tmp_path / "html"), "--page-size", "A3"], spark) == cli.OK
    assert "<p>كلمة</p><p>في</p>" in (tmp_path / "html" / "2 b.html").read_text()
    html = "".join(f'<div data-verse-key="2:{i}"><span class="translation">verse <b>{i}</b></span></div>' for i in (1, 2, 10, 1))
    spark.createDataFrame([(2, html)], "page_id long, html string").write.parquet(str(tmp_path / "pages"))
    assert cli.main(["extract", str(tmp_path / "pages"), str(tmp_path / "verses")], spark) == cli.OK
    made = spark.createDataFrame([("x", bytearray((tmp_path / "verses" / "002 - Page 2.docx").read_bytes()))], "path string, content binary")
    assert docx.paragraphs(made).first().text == "verse 1 verse 2 verse 10"


def test_size_search_and_page_review(spark):
    assert pages.largest_size(lambda points: points <= 4.2) == pytest.approx(4.2, abs=0.01)
    assert pages.largest_size(lambda points: False) == 2.0
    with pytest.raises(ValueError, match="unknown status"):
        preflight.review(spark.range(1), "fine", "")
