"""Trained operators on held-out rows and edge cases; personal data and pages against plain definitions."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from martflow.llm import ann, language, pages, pii, quality
from martflow.llm.common import held_out

SMALL = "/root/testdata/sf0.01"


def test_languages_of_held_out_documents(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    model = language.train(docs)
    found = language.predict(docs, model).withColumnRenamed("key", "doc_id")
    compared = found.join(docs.select("doc_id", "lang"), "doc_id").where(held_out(F.col("doc_id"))).collect()
    assert np.mean([r["lang"] == r["lang_pred"] for r in compared]) > 0.97
    assert np.mean([r["rejected"] for r in compared]) < 0.01
    odd = [(1, None, "x"), (2, "", "x"), (3, "123 ###", "x"), (4, "the and of " * 400_000, None), (None, "und die der", "x")]
    given = spark.createDataFrame(odd, "doc_id long, text string, lang string")
    by_key = {r["key"]: r for r in language.predict(given, model).collect()}
    assert all((by_key[k]["lang_pred"], by_key[k]["score"]) == ("und", 0.0) for k in (1, 2, 3))
    assert by_key[4]["lang_pred"] == "en" and by_key[None]["lang_pred"] == "de"
    stayed = language.with_language(given, model)
    assert {(r["doc_id"], r["lang"]) for r in stayed.collect()} == {(4, "en"), (None, "x")}


def test_calibration_finds_temperature_and_threshold():
    random_ = np.random.default_rng(1)
    targets = random_.integers(0, 3, 400)
    raw = random_.normal(0, 1, (400, 3)) + 2 * np.eye(3)[targets]
    temperature, threshold = language.calibrate(raw * 5, targets)
    # Two is the true slope, five the factor.
    assert 2 < temperature < 3
    best = language._softmax(raw * 5 / temperature).max(axis=1)
    right = raw.argmax(axis=1) == targets
    assert 0 < threshold < best[right].min()
    sure = language.calibrate(np.eye(3)[targets] * 9, targets)
    assert 0.7 < sure[1] < 0.8
    assert language.calibrate(np.eye(3)[targets[:20]] * 9, targets[:20])[1] == 0.0
    assert language.calibrate(np.zeros((0, 2)), np.zeros(0, int)) == (1.0, 0.0)


def test_gibberish_code_and_unlearnt_languages_are_rejected(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    model = language.train(docs.where("lang <> 'es'"))
    pick = random.Random(4)
    rows = [(k, "".join(pick.choice("abcdefghijklmnopqrstuvwxyz  ") for _ in range(60 + 40 * k)), "x") for k in range(50)]
    rows.append((50, "for i in range(len(buf)):\n    buf[i] = lambda q: q.pop() ^ (y << 3)  # xorshift\nimport numpy", None))
    planted = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    assert all(r["rejected"] for r in language.predict(planted, model).collect())
    assert language.with_language(planted, model).count() == 0
    found = language.predict(docs, model).withColumnRenamed("key", "doc_id").join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert np.mean([r["rejected"] for r in found if r["lang"] == "es"]) > 0.8
    assert np.mean([r["rejected"] for r in found if r["lang"] != "es"]) < 0.01


# Plain sentences whose words the invented prose of the tables does not have.
OTHER_WORDING = {
    "en": [
        "See you tomorrow!", "The cat sat on the mat.", "We are going to the cinema tonight.", "How much does this cost?",
        "Please send me the report before Friday.", "She opened the window and looked out over the garden.",
        "It was a bright cold day in April, and the clocks were striking thirteen.",
    ],
    "de": [
        "Wir gehen heute ins Kino.", "Das Wetter ist heute sehr schön.", "Wie viel kostet das?",
        "Bitte schicken Sie mir den Bericht bis Freitag.", "Ich habe gestern meine Schlüssel verloren.",
    ],
}


def test_short_texts_and_other_wording_stay(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    model = language.train(docs)
    assert model.threshold > 0 and (model.least > 0).all()
    rows = [(k, text, lang) for lang, texts in OTHER_WORDING.items() for k, text in enumerate(texts)]
    found = language.predict(spark.createDataFrame(rows, "doc_id long, text string, lang string"), model).collect()
    assert sum(r["rejected"] for r in found) <= 1
    for words in (1, 2, 5):
        first = F.array_join(F.slice(F.split("text", r"\s+"), 1, words), " ")
        short = docs.select("doc_id", first.alias("text"), F.lit(1).alias("key")).where(F.col("text").rlike(r"\p{L}"))
        rejected, total = language.predict(short, model).agg(F.sum(F.col("rejected").cast("int")), F.count("*")).first()
        assert rejected < 0.02 * total, (words, rejected, total)


def test_tiny_samples_reject_no_text_with_letters(spark):
    rows = [(2, "hello world", "en"), (3, "hallo welt", "de"), (5, "hello you", "en"), (6, "hallo du", "de")]
    odd = [(1, "hello world and all who live in it", "x"), (2, "quite other words", "x"), (3, "\u6f22\u5b57", "x"), (4, "12", "x")]
    planted = spark.createDataFrame(odd, "doc_id long, text string, lang string")
    for n in (1, 2, 4):
        docs = spark.createDataFrame(rows[:n] * 3, "doc_id long, text string, lang string").withColumn("doc_id", F.lit(0))
        model = language.train(docs)
        assert {r["key"]: r["rejected"] for r in language.predict(planted, model).collect()} == {1: False, 2: False, 3: False, 4: True}


def test_quality_of_held_out_documents(spark):
    docs, labels = (spark.read.parquet(f"{SMALL}/{t}.parquet") for t in ("documents", "labels"))
    scored = quality.scored(docs, labels).withColumnRenamed("key", "doc_id")
    found = scored.join(labels, "doc_id").where(held_out(F.col("doc_id"))).collect()
    assert np.mean([(r["score"] >= 0.5) == r["quality"] for r in found]) > 0.95
    assert all(0 <= r["score"] <= 1 for r in found)


def test_quality_without_labels_and_odd_texts(spark):
    odd = [(1, None), (2, ""), (3, "a"), (3, "a"), (4, "z " * 300_000), (None, "\n\n")]
    docs = spark.createDataFrame(odd, "doc_id long, text string")
    none = spark.createDataFrame([(1, None)], "doc_id long, quality int")
    assert [r["score"] for r in quality.scored(docs, none).collect()] == [0.5] * 6
    some = spark.createDataFrame([(k, k % 2) for k in (1, 2, 3, 3, 3)], "doc_id long, quality int")
    assert quality.scored(docs, some).count() == 6
    assert quality.scored(docs.limit(0), some).count() == 0


def test_trees_learn_a_rule():
    rows = np.random.default_rng(2).normal(size=(2000, 4))
    labels = ((rows[:, 0] > 0.3) ^ (rows[:, 2] > 0)).astype(float)
    forest = quality.fit(rows[:1500], labels[:1500])
    assert ((forest.score(rows[1500:]) >= 0.5) == labels[1500:]).mean() > 0.95


def plain_spans(text):
    found = [(*m.span(), "email") for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            found.append((*m.span(), "ip"))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m[0])
        if 12 <= len(digits) <= 19 and pii.luhn(digits):
            found.append((*m.span(), "card"))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            found.append((*m.span(), "phone"))
    return sorted(found, key=lambda s: (s[0], pii.KINDS.index(s[2])))


def test_base_spans_equal_the_patterns():
    pick = random.Random(6)
    for letters in ("ab@@..-_%+1290 ()\né", "123.0 +-", "45 -4111"):
        for _ in range(4000):
            text = "".join(pick.choice(letters) for _ in range(pick.randint(0, 40)))
            assert pii.base_spans(text) == plain_spans(text), text
    for text in ("9" * 50_000, "a" * 50_000, "1." * 30_000, "a@" * 30_000, "." * 50_000 + "@"):
        pii.base_spans(text)


def test_random_field_adds_other_spellings_and_leaves_the_rest():
    model = pii.train()
    contacts = [
        ("please mail john.smith (at) example.org today", "email"), ("call (212) 555-0199 now", "phone"),
        ("card 4111.1111.1111.1111 ok", "card"),
    ]
    for text, kind in contacts:
        assert [k for _, _, k in pii.added_spans([text], [[]], model)[0]] == [kind], text
    clean = ["in 1998 and 2004 we met", "Licensed under CC BY-NC 4.0.", 'token = "04dbebab91ab85687d33eeaa"', "a 3-2 win"]
    assert pii.added_spans(clean, [[]] * 4, model) == [[]] * 4


def test_every_accepted_spelling_of_an_address_is_decoded():
    model = pii.train()
    for text in ("write to anna at example.com today", "mail john.smith at mail.example.org please", "contact eva at example . net"):
        found = pii.added_spans([text], [[]], model)[0]
        assert [(kind, " at " in text[start:end]) for start, end, kind in found] == [("email", True)], text
    spellings = [
        f"anna{at}example{dot}com"
        for at in ("@", "(at)", " [at] ", " at ", "\tAT  ", " at\n")
        for dot in (".", " . ", ". ", "(dot)", " [dot] ", " dot ")
    ]
    for text in spellings:
        assert pii.SPOKEN_EMAIL.fullmatch(text) and pii.windows(text), text
    clean = ["she was at home. Then it rained", "see the page at www.example.com for it", "look at main.py in the folder"]
    assert pii.added_spans(clean, [[]] * 3, model) == [[]] * 3


def test_batches_decode_as_single_sequences():
    model, pick = pii.train(), random.Random(3)
    vocabulary = ["call", "(702)", "555-0742", "the", "4417.1234", "at", "x@", "dot", "10[.]2[.]3[.]4"]
    sequences = [[pick.choice(vocabulary) for _ in range(pick.randint(1, 12))] for _ in range(50)]
    together = model.decode(sequences)
    for sequence, labels in zip(sequences, together):
        assert model.decode([sequence])[0].tolist() == labels.tolist()


def test_redaction(spark):
    rows = [(1, "mail a@b.cd or +1 (702) 555-0742.", 33, "x"), (2, None, None, "y"), (3, "", 0, None), (4, "none", 4, "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_chars long, spans string")
    found = {r["doc_id"]: r for r in pii.redacted(docs).collect()}
    assert found[1]["text"] == "mail [EMAIL] or [PHONE]." and found[1]["n_chars"] == 24
    assert found[2]["text"] is None and found[3]["text"] == "" and found[4]["text"] == "none"
    assert pii.redacted(docs.limit(0)).count() == 0 and pii.spans(docs.limit(0)).count() == 0
    assert {r["key"]: len(r["base"]) for r in pii.spans(docs).collect()} == {1: 2, 2: 0, 3: 0, 4: 0}


def test_nearest_neighbours_reach_recall(spark):
    vectors = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    given = [(r["vec_id"], r["embedding"]) for r in vectors.collect()]
    ids = np.array([g[0] for g in given])
    unit = ann._unit(np.array([g[1] for g in given], float))
    found = ann.nearest(vectors).collect()
    hits = total = 0
    for row in np.flatnonzero(ids % 50 == 0):
        score = unit @ unit[row]
        score[row] = -2
        bound = np.sort(score)[-5]
        own = sorted((r["rank"], r["score"]) for r in found if r["query_id"] == ids[row])
        assert [r[0] for r in own] == [1, 2, 3, 4, 5]
        hits += sum(s >= bound - 1e-9 for _, s in own)
        total += 5
    assert hits / total >= 0.9


def test_vectors_that_take_no_part_and_ties(spark):
    rows = [(k, [1.0, float(k % 2)]) for k in range(12)]
    rows += [(50, [1.0, 0.0]), (51, None), (52, [0.0, 0.0]), (53, [1.0, None]), (54, [float("nan"), 1.0])]
    rows += [(55, [float("inf"), 1.0]), (56, [1.0]), (None, [1.0, 0.0]), (3, [1.0, 1.0])]
    found = ann.nearest(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()
    answers = {q: [r["vec_id"] for r in sorted(found, key=lambda r: r["rank"]) if r["query_id"] == q] for q in (0, 50)}
    assert answers == {0: [2, 4, 6, 8, 10], 50: [0, 2, 4, 6, 8]}
    assert ann.nearest(spark.createDataFrame([(0, None)], "vec_id long, embedding array<float>")).count() == 0


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{{}}</style><script>var t="</p>";</script></head><body>
<nav><ul><li><a href="/a">Menu</a></li></ul></nav><!-- ad --><div class="ad">Buy {n}</div>
<article><h1>Title {n}</h1><p><b>First   &amp; {n}<br><p>Second\n{n} &lt;b&gt;</p><aside>Side</aside>
<div class="comments"><p>Nice</p></div></article><footer>&copy; host &middot; foot</footer></body></html>"""


def test_main_text_of_articles(spark):
    rows = [(k, f"http://host{k % 2}.example/{k}", PAGE.format(n=k)) for k in range(150)]
    rows += [(200, None, None), (201, "http://x/", ""), (202, "http://x/", "<p>only &am"), (0, "http://host0.example/0", PAGE.format(n=0))]
    found = pages.main_texts(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert len(found) == 154
    texts = {r["page_id"]: r["text"] for r in found}
    for k in range(150):
        assert texts[k] == f"Title {k}\nFirst & {k}\nSecond {k} <b>"
    assert texts[200] == texts[201] == "" and texts[202] == "only &am"
    assert pages.main_texts(spark.createDataFrame([], "page_id long, url string, html string")).count() == 0


def test_constant_slots_are_template():
    made = [
        pages.parse(f"<div id=top>Welcome to us</div><div id=body><p>Story {k} tells</p><p>of {k}</p></div><div id=x>Call us</div>")
        for k in range(6)
    ]
    template = pages.induce(made)
    assert [pages.main_text(t, template) for t in made] == [f"Story {k} tells\nof {k}" for k in range(6)]
    count, pairs = pages.match(pages.slots(made[0]), pages.slots(made[1]))
    assert count == len(pairs) == 5


def test_template_holds_inside_articles():
    html = "<body><article><div><h2>Sign up to our letter</h2></div><h1>Title {k}</h1><p>Story {k}</p></article></body>"
    made = [pages.parse(html.format(k=k)) for k in range(6)]
    template = pages.induce(made)
    assert [pages.main_text(t, template) for t in made] == [f"Title {k}\nStory {k}" for k in range(6)]


def test_copies_of_a_page_count_once():
    html = "<body><div id=top>Welcome to us</div><div id=body>Story {k}</div></body>"
    copies = [pages.parse(html.format(k=1)) for _ in range(20)]
    template = pages.induce(copies)
    assert [pages.main_text(t, template) for t in copies] == ["Welcome to us\nStory 1"] * 20
    mixed = copies + [pages.parse(html.format(k=k)) for k in range(2, 6)]
    template = pages.induce(mixed)
    assert [pages.main_text(t, template) for t in mixed] == ["Story 1"] * 20 + [f"Story {k}" for k in range(2, 6)]


def test_pages_are_not_lost_by_a_name_or_an_omitted_tag():
    for html in (
        "<html><head><title>T</title></head><body class='has-sidebar'><p>A story is told</p></body></html>",
        "<html class='no-popup'><body><article><p>A story is told</p></article></body></html>",
        "<body><nav>Menu</nav><div class='no-comments'><p>A story is told</p></div><div class=footer>Foot</div></body>",
        "<body><div id='cookie-page'><article>A story is told</article></div><div class=ad>Buy</div></body>",
        "<body><div class='has-sidebar'><main>A story is told</main><div class=sidebar>Side</div></div></body>",
        "<body><form action=/><div>A story is told</div><nav>Menu</nav></form></body>",
        "<html><head><meta charset=utf-8><title>T</title><body><p>A story is told</body></html>",
        "<head><title>T</title><p>A story is told",
        "<title>T</title><p>A story is told",
        "<head><title>T</title><script>x</script>A story is told",
    ):
        assert pages.main_text(pages.parse(html), set()) == "A story is told", html
    teaser = "<body><p>A story is told at length here</p><div class=related><article>Next</article></div></body>"
    assert pages.main_text(pages.parse(teaser), set()) == "A story is told at length here"


def test_constant_neighbours_of_one_kind_are_template():
    body = "<body><p>Subscribe now</p><p>Story {k}</p><p>Rest {k}</p><p>Call us</p></body>"
    divs = "<body><div><ul><li>Home<li>About</ul></div><div><p>Story {k}</div><div>Imprint</div></body>"
    for html, expected in ((body, "Story {k}\nRest {k}"), (divs, "Story {k}")):
        made = [pages.parse(html.format(k=k)) for k in range(6)]
        template = pages.induce(made)
        assert [pages.main_text(t, template) for t in made] == [expected.format(k=k) for k in range(6)]


def test_no_page_is_left_without_the_template(spark):
    html = "<body><div id=top>Welcome to us</div><div id=body>Story {k}</div></body>"
    rows = [(k, f"http://h{n}.example/{k}", html.format(k=k)) for n in (65, 67, 130, 259) for k in range(n)]
    rows += [(1000 + k, "http://h67.example/copy", html.format(k=3)) for k in range(300)]
    found = pages.main_texts(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert sorted((r["url"], r["page_id"], r["text"]) for r in found) == sorted(
        (url, k, f"Story {3 if k >= 1000 else k}") for k, url, _ in rows
    )


def test_chunks_are_even_and_copies_take_one_place(monkeypatch):
    for n in (1, 3, 64, 65, 67, 128, 129, 200):
        given = [("h", k, [("/p", f"Story {k}"), ("/q", "Foot")]) for k in range(n) for _ in range(3)]
        made = list(pages.chunks(given))
        assert sorted(row for chunk, _ in made for _, same in chunk for row in same) == sorted(k for _, k, _ in given)
        assert all(len(chunk) >= min(n, 32) and len(chunk) <= 64 for chunk, _ in made)
        assert all(template == ({("/q", "Foot")} if n >= 4 else set()) for _, template in made)
    monkeypatch.setattr(pages, "HELD_ROWS", 20)
    given = [("h", k, [("/p", f"Story {min(k, 18)}"), ("/q", "Foot")]) for k in range(21)] + [("i", 0, [("/q", "Foot")])]
    assert [(len(chunk), len(template)) for chunk, template in pages.chunks(given)] == [(19, 1), (1, 1), (1, 0)]


def test_broken_and_deep_pages():
    assert pages.main_text(pages.parse("<div>" * 5000 + "deep"), set()) == "deep"
    pages.induce([pages.parse("<div>" * 3000 + str(k)) for k in range(5)])
    assert pages.main_text(pages.parse("<p>a</b></i><p>b<script>x"), set()) == "a\nb"


def most_pairs(a, b):
    """Simple tree matching by its definition."""
    if a.kind != b.kind:
        return 0
    size = [[0] * (len(b.children) + 1) for _ in range(len(a.children) + 1)]
    for i, x in enumerate(a.children):
        for j, y in enumerate(b.children):
            size[i + 1][j + 1] = max(size[i][j + 1], size[i + 1][j], size[i][j] + most_pairs(x, y))
    return size[-1][-1] + 1


@pytest.mark.parametrize("cells", [1 << 22, 4])
def test_alignment_is_that_of_the_definition(monkeypatch, cells):
    monkeypatch.setattr(pages, "CELLS", cells)
    random = np.random.default_rng(3)

    def html(depth):
        tags = random.choice(["div", "section"], random.integers(6 - depth)) if depth < 5 else []
        return "".join(f"<{tag}>{html(depth + 1)}x</{tag}>" for tag in tags)

    for _ in range(150):
        a, b = (pages.slots(pages.parse(html(1))) for _ in range(2))
        size, pairs = pages.match(a, b)
        assert size == len(pairs) == most_pairs(a, b)
        assert all(x.kind == y.kind for x, y in pairs)


def test_long_pages_are_aligned_in_time():
    import time

    random = np.random.default_rng(1)
    extra = "<div><p>More {k} {j}</p></div>"
    made = [
        pages.parse(
            "<body><div><p>Menu</p></div><main>"
            + "".join(f"<h2>Part {k} {j}</h2><p>Story {k} {j}</p>" + extra.format(k=k, j=j) * (random.random() < 0.1) for j in range(1000 - k))
            + "</main></body>"
        )
        for k in range(16)
    ]
    began = time.monotonic()
    wrapper = pages.induce(made)
    assert time.monotonic() - began < 20
    assert wrapper == {("/body/div/p", "Menu")} and wrapper.within == "/body/main"
    assert pages.main_text(made[3], wrapper).count("\n") > 1990


VARYING = """<body><div class=q1><ul><li><a href=/a>Go {k}</a><li><a href=/b>On {k}</a></ul></div><div class=q2>Buy {k} now</div>
<h1>Title {k}</h1><p class=lead>Lead {k}</p><div class=q3><section><h2>Part {k}</h2><p>{text}</p></section><div>{text}</div><p>End {k}</p></div>
<div class=q4>Imprint {k}</div></body>"""


def test_content_is_found_without_any_mark():
    made = [pages.parse(VARYING.format(k=k, text=f"Story {k} " * 80)) for k in range(8)]
    wrapper = pages.induce(made)
    assert wrapper.within == "/body/div.q3"
    for k, tree in enumerate(made):
        story = f"Story {k} " * 80
        assert pages.main_text(tree, wrapper) == f"Title {k}\nLead {k}\nPart {k}\n{story.strip()}\n{story.strip()}\nEnd {k}"
    # A page of another build keeps all that its marks leave in, and no page loses its text to a marked element.
    other = pages.parse("<body><div class=other><p>Told otherwise</p></div><nav>Menu</nav></body>")
    assert pages.main_text(other, wrapper) == "Told otherwise"
    talk = "<body><div class=text>Story {k} at some length for us all</div><div class=comments>" + "<p>I think {k}</p>" * 3 + "</div></body>"
    made = [pages.parse(talk.format(k=k)) for k in range(8)]
    assert [pages.main_text(t, pages.induce(made)) for t in made] == [f"Story {k} at some length for us all" for k in range(8)]


def test_query_equals_a_plain_reading_and_the_wrapper_decides(spark):
    import html
    import re

    directory = "/root/testdata/sf0.01"
    given = spark.read.parquet(f"{directory}/pages.parquet").withColumn("host", F.lit(1)).withColumn("text", F.lit("x"))
    found = {r["page_id"]: r["text"] for r in pages.main_texts(given.withColumn("split", F.lit(2))).collect()}
    rows = sorted((re.sub(r"^https?://([^/]*).*", r"\1", r["url"]), r["page_id"], r["html"]) for r in given.collect())
    for _, page_id, whole in rows:
        inner = re.search(r"<article>(.*)</article>", whole, re.S)[1]
        parts = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", part.replace("<br>", " "))).split()) for part in re.split(r"</?(?:p|h1)>", inner)]
        assert found[page_id] == "\n".join(part for part in parts if part), page_id
    # The same texts from the alignment alone, with no mark of any page in use.
    bare = ((host, k, [block._replace(kept=True) for block in pages.described(pages.parse(text))]) for host, k, text in rows)
    made = [(len(chunk), wrapper, kept, k) for chunk, wrapper in pages.chunks(bare) for kept, same in chunk for k in same]
    enough = [(wrapper, kept, k) for size, wrapper, kept, k in made if size >= pages.LEAST_PAGES]
    assert len(enough) > 150 and all(pages.kept_text(kept, wrapper) == found[k] for wrapper, kept, k in enough)
    assert all(len(pages.kept_text(kept, set())) > len(found[k]) for _, kept, k in enough)


def test_held_out_is_by_checksum(spark):
    import zlib

    found = spark.range(300).select("id", held_out(F.col("id")).alias("h")).collect()
    assert all(r["h"] == (zlib.crc32(str(r["id"]).encode()) % 3 == 1) for r in found)
    assert pytest.approx(sum(r["h"] for r in found) / 300, abs=0.1) == 1 / 3
