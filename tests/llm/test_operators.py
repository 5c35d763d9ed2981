"""The ten operators and the pipeline: against SQL, brute force, or a known outcome, on odd rows and on whole small tables."""

import hashlib
import os
import time
from collections import Counter

import brute
import corpus_pipeline
import pytest
from compare import normal, rows_of_duckdb, rows_of_spark
from pyspark.sql import functions as F

import duckdb
from headway.llm import byte_bpe, html, jaccard, mixing, negatives, quality, simhash, substrings, toxicity, urls, vector_codes
from headway.llm.common import QUERIES, fresh
from headway.llm.graph import components
from headway.llm.suite import ORACLES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


def documents(spark, folder):
    return [(r.doc_id, r.text, r.source) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]


def run(spark, name, folder, *columns):
    return Counter(tuple(r) for r in QUERIES[name](spark, folder).select(*columns).collect())


@pytest.mark.parametrize("name", sorted(QUERIES) + ["pipeline"])
def test_empty_tables(spark, tables, name):
    query = QUERIES.get(name, corpus_pipeline.run)
    assert query(spark, tables[1]).collect() == []


@pytest.mark.parametrize("odd", [True, False])
@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows_as_sql(spark, tables, name, odd):
    folder, con = tables[0] if odd else SF_DIR, duckdb.connect()
    for table in ("documents", "pages", "embeddings"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{folder}/{table}.parquet{'/*.parquet' if odd else ''}')")
    assert rows_of_spark(QUERIES[name](spark, folder)) == rows_of_duckdb(con, ORACLES[name])


@pytest.mark.parametrize("odd", [True, False])
def test_substrings(spark, tables, odd):
    folder = tables[0] if odd else SF_DIR
    docs = documents(spark, folder)
    wanted = Counter((d, len(brute.words(t)), len(brute.words(t)) - len(k), brute.sha(k)) for (d, t, _), k in zip(docs, brute.removed([r[:2] for r in docs])))
    assert run(spark, "op1_substring_dedup", folder, "doc_id", "n_words", "n_removed", "kept_sha256") == wanted


def test_substrings_in_many_shards(spark, monkeypatch):
    monkeypatch.setattr(substrings, "SHARD_WORDS", 500)
    docs = [(i, " ".join([f"x{i}"] * (i % 7) + [f"q{j % 97}" if (j // 60) % 3 != i % 3 else f"r{i}_{j}" for j in range(300)])) for i in range(40)]
    got = {r.doc_id: r.kept_sha256 for r in substrings.deduplicated(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == {d: brute.sha(k) for (d, _), k in zip(docs, brute.removed(docs))}


@pytest.mark.parametrize("odd", [True, False])
def test_bpe(spark, tables, odd):
    from tokenizers import Tokenizer
    import public_tokenizers

    folder = tables[0] if odd else SF_DIR
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    wanted = Counter(encoded(library, d, t) for d, t, _ in documents(spark, folder))
    assert run(spark, "op3_bpe", folder, "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == wanted


def encoded(library, doc, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return doc, len(ids), digest(" ".join(map(str, ids))), digest(library.decode(ids, skip_special_tokens=False))


@pytest.mark.parametrize("odd", [True, False])
def test_jaccard(spark, tables, odd):
    folder = tables[0] if odd else SF_DIR
    docs = [r[:2] for r in documents(spark, folder)]
    wanted = Counter((d, docs[c][0] if n or d is not None else None, n) for (d, _), (c, n) in zip(docs, brute.linked(docs)))
    assert run(spark, "op4_jaccard_join", folder, "doc_id", "class_id", "n_links") == wanted


def test_jaccard_over_many_blocks(spark, monkeypatch):
    """A large group of near copies: every link counts, whichever blocks its ends are in."""
    monkeypatch.setattr(jaccard, "BLOCK", 7)
    docs = [(i, " ".join(f"w{j}" if j not in (i % 50, 3 * i % 120) else f"n{i}" for j in range(120))) for i in range(60)] + [(99, "alone in the table here")]
    got = {r.doc_id: (r.class_id, r.n_links) for r in jaccard.joined(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == {d: (docs[c][0], n) for (d, _), (c, n) in zip(docs, brute.linked(docs))}
    assert max(n for _, n in got.values()) > 7


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 200), (200, 150)] + [(7, 7)] + [(500, 600 + i) for i in range(300)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(41)} | {i: 100 for i in (100, 150, 200)} | {500: 500} | {600 + i: 500 for i in range(300)}


@pytest.mark.parametrize("odd", [True, False])
def test_quality(spark, tables, odd):
    folder = tables[0] if odd else SF_DIR
    docs = documents(spark, folder)
    wanted = Counter((d, *brute.quality(t), k) for (d, t, _), k in zip(docs, brute.kept_by_quality(docs)))
    columns = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")
    assert run(spark, "op6_quality", folder, *columns) == wanted


def letters(n):
    return "".join(chr(97 + int(c)) for c in str(n))


def test_quality_rejects_depleted_documents(spark):
    """Digits say nothing in a line's hash, so the documents differ in letters."""
    menu = " ".join(f"m{letters(j)}" for j in range(100))
    own = [(i, menu + "\n" + " ".join(f"o{letters(i)}x{letters(j)}" for j in range(150 if i != 5 else 20)), "h") for i in range(40)]
    # near copies of one text: their longest line is one body, so their lines stay
    own += [(100 + i, " ".join(f"c{letters(j)}" for j in range(100)) + f"\ntail {letters(i)}", "h2") for i in range(40)]
    docs = spark.createDataFrame(own, "doc_id long, text string, source string")
    assert [r.doc_id for r in quality.judged(docs).where("not kept").collect()] == [5]
    assert brute.kept_by_quality(own) == [d != 5 for d, _, _ in own]


def test_quality_counts_documents_that_are_mostly_one_shared_line(spark):
    """The notice is the longest line of every document; each document is another text, by less than the threshold of copies."""
    notice = " ".join(f"m{letters(j)}" for j in range(100))
    own = [(i, notice + "\n" + " ".join(f"o{letters(i)}x{letters(j)}" for j in range(20)), "h") for i in range(40)]
    # a copy, and a near copy in another line, are no documents of their own
    own += [(100, own[0][1], "h"), (101, own[0][1] + "\nend", "h"), (102, " ".join(f"z{letters(j)}" for j in range(120)), "h")]
    got = {r.doc_id: (r.kept, r.n_removed_words) for r in quality.judged(spark.createDataFrame(own, "doc_id long, text string, source string")).collect()}
    assert got == {d: (d == 102, 0 if d == 102 else 100) for d, _, _ in own}
    few = spark.createDataFrame(own[:20] + [(200 + i, *own[0][1:]) for i in range(20)], "doc_id long, text string, source string")
    assert quality.judged(few).where("n_removed_words > 0").count() == 0  # 20 documents and their copies are not above the limit


def test_simhash(spark, tables):
    docs = sorted(((d, t) for d, t, _ in documents(spark, tables[0])), key=lambda r: (r[0] is None, r[0], hashlib.md5((r[1] or "").encode()).hexdigest()))
    wanted = Counter()
    for (d, t), (_, following) in zip(docs, docs[1:] + docs[:1]):
        new = simhash.edited(t or "", following or "")
        prints = [simhash.fingerprint(x.encode()) for x in (t or "", new, following or "")]
        bits = [(h % (1 << 64)) << 64 | l % (1 << 64) for h, l in prints]
        near = [1 - (bits[0] ^ b).bit_count() / 128 for b in bits[1:]]
        wanted[d, len(t or ""), hashlib.sha256(new.encode()).hexdigest(), f"{bits[0]:032x}", f"{bits[1]:032x}", *near] += 1
    columns = ("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")
    assert run(spark, "op8_simhash", tables[0], *columns) == wanted


def test_simhash_search_finds_all_within_the_radius(spark):
    import random
    rng = random.Random(3)
    base = [rng.getrandbits(128) for _ in range(20)]
    every = [b ^ sum(1 << k for k in rng.sample(range(128), rng.randrange(6))) for b in base for _ in range(30)]
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    rows = [(signed(x >> 64), signed(x & ((1 << 64) - 1))) for x in every]
    df = spark.createDataFrame(rows, "high long, low long")
    got = {(r.high, r.low): r.n for r in simhash.within_radius(df.limit(50), df).collect()}
    assert got == {rows[i]: sum((every[i] ^ x).bit_count() <= simhash.RADIUS for x in every) for i in range(50)}


def test_simhash_search_finds_near_copies(spark):
    """Texts with 2 % of the words replaced, similarity about 0.82, and who they are copies of; also at odd and even small radii."""
    import random
    rng = random.Random(4)
    docs = []
    for i in range(60):
        words = [f"w{rng.randrange(3000)}" for _ in range(300)]
        docs.append((i, " ".join(words)))
        for k in rng.sample(range(300), 6):
            words[k] = f"n{i}x{k}"
        docs.append((1000 + i, " ".join(words)))
    prints = {d: simhash.fingerprint(t.encode()) for d, t in docs}
    number = {d: (h % (1 << 64)) << 64 | l % (1 << 64) for d, (h, l) in prints.items()}
    df = spark.createDataFrame([(d, h, l) for d, (h, l) in prints.items()], "doc_id long, high long, low long")
    for radius in (simhash.RADIUS, 11, 1):
        got = {(r.doc_id, r.near_doc_id): r.distance for r in simhash.near_documents(df.where("doc_id < 1000"), df, radius).collect()}
        far = {(a, b): (number[a] ^ number[b]).bit_count() for a in range(60) for b in number if a != b}
        assert got == {p: n for p, n in far.items() if n <= radius}
    found = {(r.doc_id, r.near_doc_id) for r in simhash.near_documents(df.where("doc_id < 1000"), df).collect()}
    assert sum((i, 1000 + i) in found for i in range(60)) >= 57 and len(found) <= 60


def test_likeness_tells_edited_from_unrelated(spark):
    rows = QUERIES["op8_simhash"](spark, SF_DIR).where("n_chars > 300").select("near_edited", "near_next").collect()
    assert sum(r.near_edited for r in rows) / len(rows) > 0.72 and sum(r.near_next for r in rows) / len(rows) < 0.56


@pytest.mark.parametrize("odd", [True, False])
def test_mixing(spark, tables, odd):
    folder = tables[0] if odd else SF_DIR
    docs = documents(spark, folder)
    wanted = Counter((d, size, total, normal(target), whole * size + part) for (d, _, _), (size, total, target, whole, part) in zip(docs, brute.mix(docs)))
    got = run(spark, "op9_mixing", folder, "doc_id", "size", "source_size", "target", "taken")
    assert Counter({(d, s, t, normal(x), n): k for (d, s, t, x, n), k in got.items()}) == wanted


def test_repeated_keeps_columns_and_targets(spark, tables):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    out = mixing.repeated(docs)
    assert out.schema == docs.schema
    copies = {r.doc_id: r["count"] for r in out.groupBy("doc_id").count().collect()}
    for r in mixing.mixed(docs).collect():
        assert abs(copies.get(r.doc_id, 0) * r.size - r.taken) <= r.size / 2


def test_html():
    page = "<html><head><title>T</title><style>p{}</style></head><body><header>Site</header><nav><ul><li><a href=/>Home</a></ul></nav>"
    page += "<div class='cookie-notice'>We use cookies</div><article><h1>Head</h1><p>Some <b>bo</b>ld &lt;text&gt;&nbsp;here<script>x('</p>')</script><p>Short."
    page += "<form><label>Mail</label><input></form><section id=comments><article class=comment>Nice, a very long comment of a reader on this</article></section></article>"
    page += "<aside>Side</aside><footer>&copy; me</footer></body></html>"
    assert html.main_text(page) == "Head Some bold <text> here Short."
    assert html.main_text("<div id=menu><a>a</a></div><div id=main><p>A long paragraph of the text itself.</p><p>End.</p></div><div class=sidebar>s</div>") == \
        "A long paragraph of the text itself. End."
    assert [html.main_text(x) for x in (None, "", "<nav>x</nav>", "only text", "<p>unclosed <i>tag")] == ["", "", "", "only text", "unclosed tag"]
    assert html.main_text("<nav>menu<article><p>Text in a menu nobody closed</article>") == "Text in a menu nobody closed"


def test_html_keeps_content_beside_the_innermost_container():
    text = " ".join(["word"] * 100)
    story = ["Headline", "An intro " * 33 + "ends.", *[f"{text} {i}." for i in range(10)], "Closing words."]
    body = f"<h1>{story[0]}</h1><div class=intro>{story[1]}</div><div class=text>" + "".join(f"<p>{p}</p>" for p in story[2:-1]) + f"</div><p>{story[-1]}</p>"
    links = "".join(f"<div><a href=/{i}>Link {i}</a></div>" for i in range(12))
    page = f"<body><div>{links}</div><div class=post>{body}</div><div>{links}</div></body>"
    assert html.main_text(page) == " ".join(story)


def test_html_reads_marked_elements_that_hold_the_text():
    text = [" ".join(["word"] * 100) + f" {i}." for i in range(10)]
    body, whole = "<h1>Head</h1>" + "".join(f"<p>{x}</p>" for x in text), " ".join(["Head", *text])
    beside = "<div class=related><h3>Related</h3><p>Some teaser</p></div>"
    assert html.main_text(f"<body><div class='article-header'><h1>Head</h1></div><div class=x>{body[13:]}</div></body>") == whole
    assert html.main_text(f"<body><div class='layout has-sidebar'>{body}</div>{beside}</body>") == whole
    assert html.main_text(f"<body>{beside}<form id=page><fieldset>{body}</fieldset></form></body>") == whole
    assert html.main_text(f"<body>{beside}<div class='layout sidebar'>{body}</div><div id=comments>{body * 3}</div></body>") == whole
    references = "<ul><li><a href=a>First reference</a></li><li><a href=b>Second reference</a></li></ul>"
    assert html.main_text(f"<body>{references}<article>{body}{references}</article></body>") == whole + " First reference Second reference"


def test_html_pages(spark, tables):
    got = run(spark, "op2_html", tables[0], "page_id", "text", "n_chars")
    long = ("long text " * 20_000).strip()
    assert got == Counter({(1, "Title First & last line", 23): 1, (1, "", 0): 1, (None, "", 0): 1, (2, long, len(long)): 1, (3, "", 0): 1})


def test_url_intervals(spark):
    d = "2024-01-%02d"
    rows = [("e", "spam", d % 1, "add"), ("e", "spam", d % 5, "remove"), ("e", "spam", d % 9, "add"), ("e", "spam", d % 9, "remove"),
            ("e", None, d % 1, "add"), ("f.com", "allow", d % 3, "add")]
    entries = spark.createDataFrame(rows, "entry string, category string, day string, action string").withColumn("day", F.to_date("day"))
    got = {(r.entry, str(r.from_day), str(r.to_day)) for r in urls.intervals(entries).collect()}
    assert got == {("e", d % 1, d % 5), ("e", d % 9, "None"), ("f.com", d % 3, "None")}
    captures = spark.createDataFrame([(1, "http://x.f.com/", d % 2), (2, "http://x.f.com/", d % 3), (3, "http://e/", d % 1), (4, None, d % 1), (5, "http://e/", None)],
                                     "page_id long, url string, fetched string").withColumn("fetched", F.to_date("fetched"))
    assert {r.page_id: (r.n_active, r.blocked) for r in urls.judged(captures, entries).collect()} == {
        1: (0, False), 2: (1, False), 3: (1, True), 4: (0, False), 5: (0, False)}


def test_html_against_plain_paths(spark):
    import random

    draw = random.Random(4)
    tags = "div p span nav h1 li ul article form section header footer td table script body blockquote main b".split()
    bits = [f"<{t}>" for t in tags] + [f"</{t}>" for t in tags] + [
        "<a href=x>", "</a>", "<span class=ad>", "<section class=sidebar>", "<div class=header>", "<div class='comment-list'>", "<div hidden>", "<br>",
        "x ", "words of some text here ", "1 < 2 &amp; more ", "more words that go on for quite a while, as an article does, and so on, " * 2, "<a <", "<!-- c -->"]
    pages = ["".join(draw.choice(bits) for _ in range(draw.randint(1, 40))) for _ in range(1500)]
    pages += [r.html for r in spark.read.parquet(f"{SF_DIR}/pages.parquet").collect()]
    for page in pages:
        assert html.main_text(page) == brute.main_text(page, html), page


@pytest.mark.parametrize("page", [
    "<body><nav><a href=/>Home</a>{}", "<body><div class='post promo-free'>{}</div>", "<body><div class='reply-letter'>{}</div><footer>About</footer>", "<body><select><option>A{}"])
def test_html_keeps_an_article_in_an_element_named_otherwise(page):
    text = "An article goes on for many words and says what there is to say, and then it ends. " * 3
    assert html.main_text(page.format(f"<p>{text}</p>" * 3)).count("An article") == 9
    # beside an article of its own such an element is left out
    assert html.main_text(f"<body><div><p>{text}</p></div>" + page[6:].format("<p>Reader, buy this.</p>")).strip() == text.strip()


@pytest.mark.parametrize("bit", ["<div>some text here ", "<a <", "<form>x ", "<blockquote>t <h2>", "<div class=ad>some text ", "<b><i>t</b> ", "<a href='"])
def test_html_of_unclosed_tags_takes_time_of_its_length(bit):
    start = time.process_time()
    html.main_text(bit * 20_000)
    assert time.process_time() - start < 1.5


def test_toxicity_on_held_out_rows(spark):
    folder = SF_DIR.replace("sf0.001", "sf0.01")
    docs, labels = spark.read.parquet(f"{folder}/documents.parquet"), spark.read.parquet(f"{folder}/labels.parquet")
    held = F.xxhash64(F.lit("held"), "doc_id") % 4 == 0
    chain = toxicity.fit(docs, labels.where(~held))
    got = toxicity.scored(docs, chain).join(labels.where(held).withColumnRenamed("toxic", "label"), "doc_id").collect()
    right = sum(r.toxic == bool(r.label) for r in got) / len(got)
    assert len(got) > 60 and right > 0.9
    assert sum(r.toxic for r in got if r.label) >= 0.6 * sum(r.label for r in got)


def test_chain_against_plain_loops(monkeypatch):
    rows = []
    for i in range(60):
        low, toxic = int(i % 3 == 0), int(i % 5 in (0, 3))
        text = " ".join(f"w{i * j % 23}" for j in range(1, 9)) + " vile" * (toxic and i % 7 != 0) + " Buy! buy!" * (low and i % 11 != 0)
        words, shape = toxicity.features(text)
        rows.append({"doc_id": i, "fold": i * 7 % 5, "low_quality": low, "toxic": toxic, "severe": low * toxic, "words": words, "shape": shape, "text": text})
    seen = []
    threshold = toxicity.best_threshold
    monkeypatch.setattr(toxicity, "best_threshold", lambda p, y: seen.append(list(p)) or threshold(p, y))
    model = toxicity.fit_chain(rows)
    want = brute.chain(rows, toxicity.CATEGORIES, toxicity.terms_of, toxicity.FOLDS, toxicity.MIN_DOCUMENTS, toxicity.MIN_Z)
    for own, c in zip(seen, toxicity.CATEGORIES):
        assert own == pytest.approx(want[c][0], abs=1e-5)
    # the first link of a text sees nothing earlier, so its probability is that of the whole fit
    got = toxicity.predict_chain(model, [r["text"] for r in rows])
    assert list(got[:, 0]) == pytest.approx(want["low_quality"][1], abs=1e-5)


def test_rare_category_gets_a_fit_that_holds_and_a_hopeless_one_is_never_said():
    import numpy as np

    odd = np.random.default_rng(5).normal(size=(400, 6))
    y = (odd[:, 0] + odd[:, 1] > 2.6).astype(float)
    weights = toxicity.fit_linear(odd * 9, y)
    p = toxicity.sigmoid(odd * 9 @ weights[:-1] + weights[-1])
    assert 5 < y.sum() < 30 and np.abs(weights).max() < 50 and ((p > 0.5) == (y > 0)).mean() > 0.98
    assert toxicity.best_threshold(p, y) < 1
    chance = np.linspace(0, 1, 400)
    assert toxicity.best_threshold(chance, np.tile([1.0] + [0.0] * 39, 10)) == toxicity.NEVER
    assert toxicity.best_threshold(np.zeros(0), np.zeros(0)) == toxicity.NEVER


def test_steps_of_wide_fits_are_solved_without_the_square_of_the_terms(monkeypatch):
    import numpy as np

    some = np.random.default_rng(9)
    x = (some.random((300, 500)) < 0.05) * some.normal(1, 0.2, (300, 500))
    y = (x[:, :5].sum(1) > some.random(300)).astype(float)
    ridge, curve, slope = np.full(500, 1.0), some.uniform(0.01, 0.25, 300), some.normal(size=500)
    want = np.linalg.solve((x.T * curve) @ x + np.diag(ridge), slope)
    assert np.abs(toxicity.newton_step(x, curve, ridge, slope, 1e-10) - want).max() < 1e-8
    monkeypatch.setattr(np.linalg, "solve", None)
    weights = toxicity.fit_linear(x, y)
    p = toxicity.sigmoid(x @ weights[:-1] + weights[-1])
    assert np.abs(x.T @ (y - p) - weights[:-1]).max() < 1e-6 and abs((y - p).sum()) < 1e-4


def test_toxicity_on_odd_rows(spark, tables):
    got = QUERIES["op7_toxicity"](spark, tables[0]).collect()
    assert len(got) == len(documents(spark, tables[0])) and all(0 <= r.p_toxic <= 1 for r in got)


def test_names_do_not_clash(spark):
    assert fresh(spark.range(1).selectExpr("id AS Row_Id"), "row_id", "x") == ["_row_id", "x"]


@pytest.mark.parametrize("odd", [True, False])
def test_pipeline(spark, tables, odd):
    from tokenizers import Tokenizer
    import public_tokenizers

    folder = tables[0] if odd else SF_DIR
    rows = documents(spark, folder)
    rows = [r for r, kept in zip(rows, brute.kept_by_quality(rows)) if kept]
    rows = [r for i, (r, (c, _)) in enumerate(zip(rows, brute.linked([x[:2] for x in rows]))) if c == i]
    cut = brute.removed([r[:2] for r in rows])
    rows = [(d, t if len(k) == len(brute.words(t)) else b" ".join(k).decode(), s) for (d, t, s), k in zip(rows, cut) if k]
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    wanted = Counter()
    for (d, t, _), (size, _, _, whole, part) in zip(rows, brute.mix(rows)):
        wanted[encoded(library, d, t)] += whole + (2 * part >= size > 0)
    got = Counter(tuple(r) for r in corpus_pipeline.run(spark, folder).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect())
    assert got == +wanted
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = spark.read.parquet(f"{folder}/documents.parquet")
        assert stage(spark, docs, folder).columns == docs.columns


def ranked_codec():
    import public_tokenizers
    import tiktoken

    ranks, pattern = byte_bpe.vocabulary()
    assert pattern == public_tokenizers.PATTERN
    return byte_bpe.Codec(ranks, pattern), tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


@pytest.mark.parametrize("odd", [True, False])
def test_byte_bpe(spark, tables, odd):
    folder, (_, library) = tables[0] if odd else SF_DIR, ranked_codec()
    wanted = Counter()
    for doc, text, _ in documents(spark, folder):
        ids = library.encode_ordinary(text or "")
        packed = b"".join(i.to_bytes(4, "little") for i in ids)
        wanted[doc, len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256(library.decode_bytes(ids)).hexdigest()] += 1
    assert run(spark, "op12_byte_bpe", folder, "doc_id", "n_tokens", "ids_sha256", "decoded_sha256") == wanted


@pytest.mark.parametrize("leaf", [1, 3, 16])
def test_byte_bpe_joins_at_every_border(monkeypatch, leaf):
    """Strings without separators, cut anywhere: joined ids are those of merging the whole string."""
    import random

    monkeypatch.setattr(byte_bpe, "LEAF_BYTES", leaf)
    (codec, library), some = ranked_codec(), random.Random(leaf)
    for _ in range(400):
        letters = some.sample(["a", "ab", "b", "the", "ing", "é", "漢", "का", "😀", "aaa", "7", "_"], some.choice([1, 2, 4]))
        text = "".join(some.choice(letters) for _ in range(some.choice([2, 9, 70])))
        data, cut = text.encode(), some.randrange(len(text.encode()) + 1)
        whole = codec.merged(data)
        assert codec.tree(data) == whole == codec.joined(codec.merged(data[:cut]), codec.merged(data[cut:]))
        ids = library.encode_ordinary(text)
        assert codec.encode(text) == b"".join(i.to_bytes(4, "little") for i in ids)


def test_byte_bpe_of_a_long_run():
    codec, library = ranked_codec()
    for text in ("a" * 20_003, " " * 30_000 + "x", "".join(f"w{i * i % 977}" for i in range(9_000))):
        assert codec.encode(text) == b"".join(i.to_bytes(4, "little") for i in library.encode_ordinary(text))


def test_byte_bpe_in_steps(monkeypatch):
    monkeypatch.setattr(byte_bpe, "STEP", 3)
    monkeypatch.setattr(byte_bpe, "KNOWN", 2)
    codec, library = ranked_codec()
    text = "It's 42 words, isn't it?\n\n  more of them " * 5
    ids = codec.encode(text)
    assert ids == b"".join(i.to_bytes(4, "little") for i in library.encode_ordinary(text))
    assert codec.decode(__import__("numpy").frombuffer(ids, "<u4")) == text.encode()


def test_negatives_in_many_blocks_groups_and_waves(spark, monkeypatch):
    """Small blocks, several groups of anchors and several waves give the rows of SQL."""
    for name, value in (("BLOCK_ROWS", 20), ("GROUP", 3), ("CHUNK", 2), ("WAVE", 2), ("GROWTH", 3)):
        monkeypatch.setattr(negatives, name, value)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{SF_DIR}/embeddings.parquet') WHERE vec_id < 300")
    rows = spark.read.parquet(f"{SF_DIR}/embeddings.parquet").where("vec_id < 300").repartition(3)
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    got = negatives.hard_negatives(rows.withColumn("label", label), F.col("vec_id") % 50 == 0)
    assert rows_of_spark(got) == rows_of_duckdb(con, negatives.SQL)


def test_segment_bounds_hold():
    import numpy as np

    some = np.random.default_rng(1)
    for width, size in ((1, 3), (5, 1000), (64, 60), (64, 1 << 27)):
        matrix = some.integers(-size, size, (40, width)) // some.integers(1, 50, (40, 1))
        exact = matrix.astype(object) @ matrix.T.astype(object)
        for segments in negatives.SEGMENTS:
            means, spreads = (x.astype(float) for x in negatives.summary(matrix, segments))
            assert (np.abs(exact.astype(float) - means @ means.T) <= spreads @ spreads.T).all()


def test_vector_codes_in_small_blocks(spark, monkeypatch):
    """Many blocks with deep trees, parts that are clusters so that whole nodes are assigned, and a repeated run."""
    import numpy as np

    monkeypatch.setattr(vector_codes, "BLOCK_ROWS", 100)
    monkeypatch.setattr(vector_codes, "LEAF_ROWS", 2)
    some = np.random.default_rng(2)
    rows = [(i, (np.repeat(some.integers(-9, 9, 4), 2) + some.normal(0, 0.01, 8)).tolist(), i % 3) for i in range(350)] + [(400 + i, [1.5] * 8, None) for i in range(120)]
    data = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").repartition(3)
    got, books = vector_codes.compressed(data, scale=100, parts=4, entries=5, rounds=4)
    plain = [(i, brute.floored(v, 100)) for i, v, _ in rows]
    wanted, wanted_books = brute.codes(plain, 4, 5, 4)
    assert books.tolist() == wanted_books
    assert {r.vec_id: (r.code, r.error) for r in got.collect()} == wanted


def test_vector_codes_of_few_rows(spark):
    data = spark.createDataFrame([(3, [1.0, 2.0], 1), (1, [5.0, 6.0], 1), (1, [5.0, 6.0], 1), (None, [9.0, 9.0], None)], "vec_id long, embedding array<double>, label int")
    got, books = vector_codes.compressed(data, scale=1, parts=2)
    assert books.tolist() == [[[5], [1], [9]], [[6], [2], [9]]]
    assert sorted((r.vec_id or 0, r.code, r.error) for r in got.collect()) == [(0, "0202", 0), (1, "0000", 0), (1, "0000", 0), (3, "0101", 0)]


def test_whole_nodes_are_assigned_by_their_sums(monkeypatch):
    """Two far clusters: no part is compared with an entry."""
    import numpy as np

    points = np.concatenate([np.arange(200).reshape(-1, 2), 10_000 + np.arange(200).reshape(-1, 2)]).astype(np.int64)
    tree = vector_codes.PartTree(*vector_codes.PartTree.grown(points))
    monkeypatch.setattr(vector_codes.PartTree, "_distances", None)
    sums, counts, codes = tree.assigned(np.array([[0, 0], [10_000, 10_000]]), True)
    assert counts.tolist() == [100, 100] and sums.tolist() == [points[:100].sum(0).tolist(), points[100:].sum(0).tolist()]
    assert codes[np.argsort(tree.order)].tolist() == [0] * 100 + [1] * 100
