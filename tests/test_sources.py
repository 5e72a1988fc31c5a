import json
import zipfile

import pytest
from pyspark.sql import functions as F

from kanaat.functions.fixed_values import CATEGORIES
from kanaat.operators import categories, extract, labelling, sampling
from kanaat.operators.html import Page
from kanaat.sources import checkpoints, files, sinks, workbooks
from kanaat.streaming import feed


def test_csv_quotes_breaks_and_na(spark, tmp_path):
    (tmp_path / "c.csv").write_text('Tarih,Yorum\nd1,"a ""quoted""\nline"\nNA,nan\nd3,\n', encoding="utf-8")
    plain = files.read_csv(spark, str(tmp_path / "c.csv"))
    assert plain.columns == ["Tarih", "Yorum"]
    assert sorted(map(tuple, plain.collect()), key=str) == [("NA", "nan"), ("d1", 'a "quoted"\nline'), ("d3", None)]
    nulled = files.read_csv(spark, str(tmp_path / "c.csv"), na_tokens=True)
    assert nulled.where("Tarih is null and Yorum is null").count() == 1


def test_csv_round_trip(spark, tmp_path):
    rows = [("t1", 'x "y", z'), ("t2", "two\nlines")]
    df = spark.createDataFrame(rows, "Tarih string, Yorum string")
    sinks.write_csv(df, str(tmp_path / "o"))
    sinks.write_csv(df, str(tmp_path / "o"), append=True)
    assert sorted(map(tuple, files.read_csv(spark, str(tmp_path / "o")).collect())) == sorted(rows * 2)
    sinks.write_json(df, str(tmp_path / "j"))
    assert spark.read.json(str(tmp_path / "j")).count() == 2


def labelled_folder(tmp_path):
    folder = tmp_path / "labels"
    folder.mkdir()
    (folder / "Teslimat_x.csv").write_text("Tarih, YORUM ,sonuc\nt,hızlı geldi,1.0\nt,geç geldi,0\nt,,1\n", encoding="utf-8")
    (folder / "Teslimat_Süresi_x.csv").write_text("Tarih,Yorum,Sonuç\nt,aynı gün,Evet\n", encoding="utf-8")
    (folder / "Ürün.csv").write_text("Tarih,Başka\nt,q\n", encoding="utf-8")
    return str(folder)


def test_labelled_folder(spark, tmp_path):
    rows = files.canonical_labels(files.read_labelled_csv(spark, labelled_folder(tmp_path)))
    got = sorted((r.category, r.text, r.label) for r in rows.collect())
    assert got == [("Teslimat_Süresi_x", "aynı gün", 1), ("Teslimat_x", "geç geldi", 0), ("Teslimat_x", "hızlı geldi", 1)]


def test_longest_prefix_and_merge(spark, tmp_path):
    folder = labelled_folder(tmp_path)
    found = files.one_file_per_category(files.list_files(spark, folder, "*.csv")).select("category").collect()
    assert sorted(r.category for r in found) == ["Teslimat", "Teslimat_Süresi", "Ürün"]
    (tmp_path / "labels" / "Teslimat_x.csv").write_text("Tarih,Yorum,Sonuç\nt,a,1\nt,b,0\n", encoding="utf-8")
    merged, missing = files.merge_labelled_csv(spark, folder)
    assert merged.count() == 3 and "Stok" in missing and "Teslimat" not in missing
    assert merged.agg(F.sum("Teslimat"), F.sum("Teslimat_Süresi"), F.sum("Stok")).first()[:] == (2, 1, 0)


def workbook(path, rows):
    strings = sorted({c for r in rows for c in r if isinstance(c, str)})
    shared = "".join(f"<si><t>{s}</t></si>" for s in strings)
    body = ""
    for i, row in enumerate(rows, 1):
        cells = ""
        for j, c in enumerate(row):
            if c is None:
                continue
            kind, value = (' t="s"', strings.index(c)) if isinstance(c, str) else ("", c)
            cells += f'<c r="{chr(65 + j)}{i}"{kind}><v>{value}</v></c>'
        body += f'<row r="{i}">{cells}</row>'
    space = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    with zipfile.ZipFile(path, "w") as book:
        book.writestr("xl/sharedStrings.xml", f"<sst {space}>{shared}</sst>")
        book.writestr("xl/worksheets/sheet1.xml", f"<worksheet {space}><sheetData>{body}</sheetData></worksheet>")


def test_workbooks(spark, tmp_path):
    workbook(tmp_path / "Ürün.xlsx", [["Tarih", "Yorum ", "Sonuç"], ["t1", "iyi", 1], [None, "kötü", 0]])
    (tmp_path / "Stok.xlsx").write_bytes(b"not a workbook")
    rows, broken = workbooks.read_workbooks(spark, str(tmp_path))
    assert [r.name for r in broken.collect()] == ["Stok.xlsx"]
    table = workbooks.labelled_workbooks(rows)
    assert sorted(tuple(r) for r in table.select("category", "Yorum", "Sonuç").collect()) == [("Ürün", "iyi", "1"), ("Ürün", "kötü", "0")]
    assert files.canonical_labels(table).agg(F.sum("label")).first()[0] == 1


def test_checkpoint_counts_only_for_same_targets(spark, tmp_path):
    saved = {"category": "Stok", "target_positive": 2, "target_negative": 3, "count_positive": 1, "count_negative": 1,
             "results": [{"Tarih": "t", "Yorum": "a", "Sonuç": 1}, {"Tarih": "t", "Yorum": "b", "Sonuç": 0}],
             "processed_indices": [4, 9, 11], "timestamp": "2024-01-01T00:00:00"}
    (tmp_path / "Stok_checkpoint.json").write_text(json.dumps(saved, ensure_ascii=False), encoding="utf-8")
    found = checkpoints.read_checkpoints(spark, str(tmp_path))
    assert checkpoints.resumable(found, "Stok", 2, 4).count() == 0
    same = checkpoints.resumable(found, "Stok", 2, 3)
    assert checkpoints.results(same).count() == 2
    rows = spark.createDataFrame([(i, "Stok") for i in range(12)], "comment_id long, category string")
    assert labelling.unlabelled(rows, checkpoints.processed(same)).count() == 9


def test_keywords(spark):
    got = {r.category: r.keywords for r in categories.dimension(spark).collect()}
    assert len(got) == 16
    assert got["İndirim"][:2] == ["Kampanya", "Fırsat"] and got["Boykot"][0] == "Boykot"


def unsteady():
    tries = {}

    def ask(prompt):
        tries[prompt] = tries.get(prompt, 0) + 1
        if "hiç" in prompt or ("bazen" in prompt and tries[prompt] < 3):
            raise RuntimeError
        return "evet" if "iyi" in prompt else "0"

    return ask


def test_labeller_retries_and_flags(spark):
    rows = [(1, "k", "bazen iyi"), (2, "k", "hiç"), (3, "k", "kötü"), (4, "k", "kötü"), (5, "k", " ")]
    df = spark.createDataFrame(rows, "comment_id long, category string, text string")
    got = {r.comment_id: (r.label, r.attempts, r.failed) for r in labelling.label_comments(df, unsteady, [("k", "x")], pause=0.0).collect()}
    assert got == {1: (1, 3, 0), 2: (0, 3, 1), 3: (0, 1, 0), 4: (0, 1, 0)}


def steady():
    return lambda prompt: "1" if "iyi" in prompt.split("YORUM")[1].split("kategorisi")[0] else "hayır"


def test_unknown_category_stays_and_is_flagged(spark):
    rows = spark.createDataFrame([(1, "articles", "the text"), (2, "nowhere", "the text")], "comment_id long, category string, text string")
    out = {r.comment_id: r for r in labelling.label_comments(rows, lambda: lambda prompt: "1", [("articles", "about articles")], pause=0.0).collect()}
    assert (out[1].label, out[1].failed) == (1, 0) and (out[2].label, out[2].attempts, out[2].failed) == (0, 0, 1)


def test_labelling_in_slices_gives_the_same_sample(spark):
    rows = [(i, c, "iyi" if i % 5 == 0 else "yok") for i in range(200) for c in ("a", "b")]
    df = spark.createDataFrame(rows, "comment_id long, category string, text string")
    pairs = [("a", ""), ("b", "")]
    sliced = labelling.label_until_quota(df, steady, 6, 9, pairs, pause=0.0).select("category", "comment_id").collect()
    whole = sampling.quota_sample(labelling.label_comments(df, steady, pairs, pause=0.0), 6, 9).select("category", "comment_id").collect()
    assert sorted(sliced) == sorted(whole) and len(whole) == 30


PAGE = """<html><script>var x = '<div class="content">no</div>';</script><body>
<div class="complaint-card big"><p>t<a href="/migros/1?x=1&amp;y=2">one</a><a href="/other">two</a></div>
<a class="complaint-layer" href="/migros/9">nine</a>
<div class='js-tooltip time-ago'> 3 Mart </div><div class="complaint-detail"> </div>
<article class="complaint-content">Kargo <b>geç</b>
 geldi &amp; kırık<br>!</article>
<ul><li id="entry-item-1"><div class="content">ilk<br>satır</div><footer><a class="entry-date">01.02.2024</a></footer></li>
<li id="entry-item-2"><div class="content">ikinci</div><footer>dün</footer></li><li id="entry-item-3"><div class="content">üç</div></li>
<li id="x"><div class="content">değil</div></li></ul>
<div class="aa RHo1pe"><span class="bp9Aid">5 Ocak</span><div class="h3YV2d">Güzel</div></div>
<div class="RHo1pe"><span class="bp9Aid">6 Ocak</span></div></body></html>"""


def pages(spark):
    return spark.createDataFrame([(1, "https://s.com/migros?page=1", PAGE), (2, "https://s.com/migros?page=2", ""), (3, "u", None)],
                                 "page int, url string, html string")


def test_selectors():
    page = Page(PAGE)
    assert [e.get("href") for e in page.select(".complaint-card a")] == ["/migros/1?x=1&y=2", "/other"]
    assert page.text(page.select("article.complaint-content")[0]) == "Kargo geç\n geldi & kırık!"
    assert len(page.select("div.content")) == 4 and page.select("div.none") == []


def test_extraction(spark):
    links = extract.page_links(pages(spark), "page", "url", "html", "migros").collect()
    assert [tuple(r) for r in links] == [(1, 1, "https://s.com/migros/1?x=1&y=2")]
    found = extract.complaints(pages(spark), ["page"], "html").collect()
    assert [tuple(r) for r in found] == [(1, "Kargo geç geldi & kırık!", "3 Mart")]
    entries = extract.entries(pages(spark), ["page"], "html").orderBy("position").collect()
    assert [(r.content, r.date_text) for r in entries] == [("ilksatır", "01.02.2024"), ("ikinci", "dün"), ("üç", "Tarih bulunamadı")]
    cards = extract.reviews(pages(spark), ["page"], "html").collect()
    assert [(r.date_text, r.text) for r in cards] == [("5 Ocak", "Güzel")]


def test_feed_restart_adds_nothing(spark, tmp_path):
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    first = spark.createDataFrame([("d", "x" * 60), ("d", "x" * 60 + "other"), ("e", "y")], "tarih string, yorum string")
    first.write.parquet(source)

    def run():
        stream = feed.unseen_reviews(feed.read_feed(spark, source, first.schema), "tarih", "yorum")
        feed.append_to(stream, out, state).awaitTermination()
        return spark.read.parquet(out).count()

    assert run() == 2
    assert run() == 2
    first.limit(1).union(spark.createDataFrame([("f", "new")], first.schema)).write.mode("append").parquet(source)
    assert run() == 3


def test_label_feed_skips_labelled_rows(spark, tmp_path):
    source, out, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    rows = spark.createDataFrame([(1, "a"), (2, "b")], "id int, text string")
    rows.write.parquet(source)

    def run():
        stream = feed.read_feed(spark, source, rows.schema)
        feed.label_feed(stream, lambda b: b.withColumn("label", F.lit(1)), out, state, ["id"]).awaitTermination()
        return sorted(r.id for r in spark.read.parquet(out).collect())

    assert run() == [1, 2]
    spark.createDataFrame([(2, "b"), (3, "c")], rows.schema).write.mode("append").parquet(source)
    assert run() == [1, 2, 3]


def test_checkpoint_folder_is_required_on_a_cluster(monkeypatch):
    from kanaat import session

    class Context:
        master = "yarn"

        def getConf(self):
            return {}

        def getCheckpointDir(self):
            return None

    class Spark:
        sparkContext = Context()
        conf = {}

    monkeypatch.setattr(Spark.sparkContext, "getConf", lambda: {}, raising=False)
    monkeypatch.setattr(Spark, "conf", type("C", (), {"get": staticmethod(lambda k, d=None: d)}), raising=False)
    with pytest.raises(RuntimeError):
        session.checkpoint_folder(Spark())
