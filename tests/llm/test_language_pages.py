"""The registered query over pages uses markup language, address suffix and the levels above the host."""
from pyspark.sql import functions as F

from barlake.llm import language, queries

DE = "der Hund und die Katze sind nicht in dem Haus und auch nicht auf der Strasse"
EN = "the dog and the cat are not in the house and they are not on the street"


def test_markup_language(spark):
    pages = ["<!DOCTYPE html><html lang='de-AT'>", '<HTML class="a b" LANG = "fr">', "<html xml:lang=es>", "<html>", None, "",
             "<html data-lang='x'><p lang='de'>", "<html\nlang=en dir=ltr>"]
    df = spark.createDataFrame([(i, p) for i, p in enumerate(pages)], "i int, html string")
    got = [r[0] for r in df.orderBy("i").select(language.markup_language(F.col("html"))).collect()]
    assert got == ["de-AT", "fr", "es", None, None, None, None, "en"]


def test_evidence_beside_the_text_decides(spark, tmp_path):
    page = lambda lang, text: f"<html{lang}><body><article><p>{text}</p></article></body></html>"
    rows = [(f"http://h{i % 4}.haus.de/{i}", page(" lang='de'", f"{DE} {i}")) for i in range(40)]
    rows += [(f"http://h{i % 4}.house.com/{i}", page(" lang='en'", f"{EN} {i}")) for i in range(60)]
    rows += [("http://new.haus.de/1", page("", "zzz")), ("http://new.other.de/1", page("", "zzz")),   # domain, suffix
             ("http://new.house.com/1", page("", "zzz")), (None, page(" lang='de'", "zzz")),        # domain, markup
             ("http://new.haus.de/2", page("", "12")), (None, None)]
    spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "page_id long, url string, html string").write.parquet(
        str(tmp_path / "pages.parquet"))
    got = {r.page_id: r for r in queries.QUERIES["op10_pages"](spark, str(tmp_path)).collect()}
    assert len(got) == len(rows)
    assert [got[100 + k].language for k in range(4)] == ["de", "de", "en", "de"]
    assert all(got[i].language == ("de" if i < 40 else "en") and got[i].kept for i in range(100))
    assert not got[104].kept and not got[105].kept and got[103].declared_language == "de"


def test_pages_of_the_fixture(spark):
    sf = "/root/testdata/sf0.001"
    got = queries.op10_pages(spark, sf).collect()
    assert len(got) == queries.table(spark, sf, "pages").count() and all(r.declared_language for r in got)
    assert sum(r.language == r.declared_language for r in got) > 0.95 * len(got)
