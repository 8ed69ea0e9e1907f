"""Each operator against brute force on small tables: nulls, empty and long texts, ties, repeated rows, empty tables, clashing columns."""

import gc
import hashlib
import html
import re
import time
import zlib
from collections import Counter, defaultdict
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline
from rowtrail.llm import byte_bpe, common, copies, fingerprints, language_id, line_dedup, main_text, mixing, near_dedup, quality_classifier, quality_rules, queries, sharding

SF_DIR = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LONG = "word of a very long text " * 20_000
ODD = [
    (1, None, "en", "a", None), (2, "", "en", None, 0), (3, LONG, "de", "a", len(LONG)), (4, " \n\t ", None, "b", 4), (5, "Ünï 日本 😀 x", "fr", "b", 11), (5, "Ünï 日本 😀 x", "fr", "b", 11),
    (None, "no id", "en", "c", 5), (None, "no id", "en", "c", 5), (6, "a b c\na b c\n\nz", "en", "a", 14), (7, "one", "en", "zz", 3), (-8, "12 ! 34", "es", "b", 7)]
WORDS = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(ODD, SCHEMA)


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")


def clashing(frame):
    """The same rows with columns named like those the operators make."""
    return frame.withColumns({c: F.lit(1) for c in ("size", "score", "found", "component_id", "key", "lines", "mix", "near", "quality", "predicted", "slot", "taken", "kept", "Draw")})


def test_every_operator_is_registered_once():
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES if n.startswith("op")) == list(range(1, 14)) and "pipeline" in queries.QUERIES


def test_byte_bpe_equals_the_public_library(spark, odd, documents):
    path, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    ranks = {token: rank for rank, token in enumerate(byte_bpe.read_ranks(path))}
    other = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})
    for frame in (odd, documents.select("doc_id", "text"), odd.limit(0), clashing(odd)):
        got = Counter(map(tuple, byte_bpe.round_trip(spark, frame, path, pattern).collect()))
        want = Counter()
        for doc_id, text in frame.select("doc_id", "text").collect():
            ids = other.encode_ordinary(text or "")
            want[doc_id, len(ids), hashlib.sha256(b"".join(i.to_bytes(4, "little") for i in ids)).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()] += 1
        assert got == want
    ids = odd.select("text", byte_bpe.encode_column(spark, F.col("text"), path, pattern).alias("ids"))
    assert all(bytes(r.back).decode() == (r.text or "") for r in ids.select("text", byte_bpe.decode_column(spark, F.col("ids"), path).alias("back")).collect())


def test_language_is_learned_from_labels(spark, odd, documents):
    rows = queries.op1_language_id(spark, SF_DIR).join(documents.select("doc_id", "lang"), "doc_id").filter("held_out").collect()
    assert sum(r.lang_pred == r.lang for r in rows) >= 0.97 * len(rows) and all(0 <= r.score <= 1 for r in rows)
    known = language_id.dictionaries(documents, F.lit(True))
    found = odd.select("doc_id", language_id.identify_column(spark, F.col("text"), known).alias("f")).select("doc_id", "f.*").collect()
    assert {r.doc_id: r.best for r in found if r.doc_id in (1, 2, 4, -8)} == {1: "und", 2: "und", 4: "und", -8: "und"}
    assert all(r.best in dict(known) for r in found if r.doc_id in (3, 5, 7))
    assert language_id.dictionaries(odd.limit(0), F.lit(True)) == []
    assert language_id.Identifier([]).identify("text")[2] == "und"


def plain_language(text, known):
    """Nearest language, score and whether it is rejected: every block compressed by itself, with a compressor of its own."""
    import math

    import zstandard

    content = " ".join("".join(c if ord(c) > 127 or c.isalpha() else " " for c in text.lower()).split(" ")).encode()
    content = b" ".join(content.split())
    if not any(c.isalpha() for c in text):
        return "und", 0.0, True
    settings = zstandard.ZstdCompressionParameters(write_content_size=False, write_dict_id=False, **language_id.MATCHING)
    sizes = []
    for _, dictionary in known:
        size = 0
        for start in range(0, len(content), 4096):
            shared = zstandard.ZstdCompressionDict(dictionary, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            shared.precompute_compress(compression_params=settings)
            size += len(zstandard.ZstdCompressor(compression_params=settings, dict_data=shared).compress(content[start:start + 4096]))
        sizes.append(size)
    first = min(range(len(sizes)), key=lambda k: sizes[k])
    second = min(size for k, size in enumerate(sizes) if k != first)
    return known[first][0], 1 / sum(math.exp(-40.0 * (size / sizes[first] - 1)) for size in sizes), (second - sizes[first]) / sizes[first] < 0.01


def test_languages_equal_plain_compression(spark, documents):
    usable = [r for r in documents.select("doc_id", "lang", "text", F.xxhash64("text").alias("hash")).collect() if zlib.crc32(str(r.doc_id).encode()) % 5 and r.lang is not None and r.text]
    chosen = {}
    for r in usable:
        slot = r.lang, r.hash % language_id.SLOTS
        chosen[slot] = min(chosen.get(slot, (r.hash, r.text)), (r.hash, r.text))
    excerpts = defaultdict(set)
    for (lang, _), (h, text) in chosen.items():
        spot = h % max(1, len(text) - language_id.EXCERPT + 1)
        excerpts[lang].add((h, text[spot:spot + language_id.EXCERPT]))
    plain = lambda t: b" ".join("".join(c if ord(c) > 127 or c.isalpha() else " " for c in t.lower()).encode().split())
    texts = Counter(r.lang for r in usable)
    known = [(lang, b" ".join(plain(t) for _, t in sorted(excerpts[lang]))) for lang in sorted(excerpts, key=lambda lang: (-texts[lang], lang))]
    of = {r.doc_id: r.text or "" for r in documents.select("doc_id", "text").collect()}
    got = queries.op1_language_id(spark, SF_DIR).collect()
    assert len(got) == len(of)
    for r in got:
        lang, score, rejected = plain_language(of[r.doc_id], known)
        assert (r.lang_pred, r.rejected) == (lang, rejected) and r.score == pytest.approx(score)
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)


def brute_lines(rows, min_sites, group=None):
    """(doc_id, text) without wide lines; ``group`` of a text: texts of one group count for the site of theirs with the fewest rows."""
    form = lambda line: " ".join(WORDS.findall(line)).translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    group = group or (lambda text: text)
    busy = Counter(source for _, text, source in rows if text is not None)
    owned = defaultdict(set)
    for _, text, source in rows:
        if text is not None and source is not None:
            owned[group(text)].add((busy[source], source))
    sites = defaultdict(set)
    for _, text, source in rows:
        if text is not None and source is not None and source == min(owned[group(text)])[1]:
            for line in text.split("\n"):
                sites[form(line)].add(source)
    out = Counter()
    for doc_id, text, _ in rows:
        out[doc_id, None if text is None else "\n".join(line for line in text.split("\n") if not form(line) or len(sites[form(line)]) < min_sites)] += 1
    return out


def test_lines_on_many_sites_go(spark, odd):
    own = [(100 + i, f"Own text number {i} of its own page, and more of it\nAll  RIGHTS reserved\nsecond own line {i}", "en", f"s{i % 14}", 0) for i in range(40)]
    short = [(400 + i, f"All rights reserved\n{i}\nall RIGHTS  reserved\n", "en", f"s{i % 14}", 0) for i in range(20)]
    rare = [(200 + i, f"A page of its own, once more, {i}\nonly on nine", "en", f"s{i % 9}", 0) for i in range(30)]
    copies = [(300 + i, "the same text\non every site", "en", f"s{i}", 0) for i in range(14)]
    frame = spark.createDataFrame(own + short + rare + copies + ODD, SCHEMA)
    for given in (frame, clashing(frame), odd.limit(0), odd):
        got = line_dedup.remove_boilerplate(given)
        assert got.columns == given.columns
        rows = given.select("doc_id", "text", "source").collect()
        assert Counter((r.doc_id, r.text) for r in got.collect()) == brute_lines([tuple(r) for r in rows], line_dedup.MIN_SITES)
    kept = {r.doc_id: r.text for r in line_dedup.remove_boilerplate(frame).collect()}
    assert "reserved" not in kept[100] and "only on nine" in kept[200] and kept[300] == "the same text\non every site"
    assert kept[400] == "0\n", "a page made mostly of boilerplate loses it too"


def test_copies_make_no_line_wide_and_every_wide_line_goes(spark):
    article = [" ".join(f"w{i}-{j}" for j in range(20)) for i in range(12)]
    text = lambda edit: "\n".join(line if i != edit else "an edited line" for i, line in enumerate(article))
    copies = [(i, text(None), "en", f"s{i}", 0) for i in range(12)]
    near = [(20 + i, text(i) + f"\nits own end {i}", "en", f"s{i}", 0) for i in range(12)]
    nameless = [(None, "a text without an id\non every site", "en", f"s{i}", 0) for i in range(12)]
    pages = [(100 + i, f"own {i}" + ("\nAll rights reserved by all of the owners of this site" if i % 5 else ""), "en", f"s{i % 12}", 0) for i in range(48)]
    mirrored = [(200 + i, f"page number {i} of a mirror\nOn every site and on its mirror", "en", site, 0) for i in range(24) for site in (f"s{i % 12}", "a mirror")]
    frame = spark.createDataFrame(copies + near + nameless + pages + mirrored, SCHEMA)
    cleaned = corpus_pipeline.held(corpus_pipeline.without_boilerplate(spark, frame, SF_DIR), "test-cleaned")
    want = Counter((r[0], r[1]) for r in copies + near + nameless) + Counter((r[0], r[1].split("\n")[0]) for r in pages + mirrored)
    assert Counter((r.doc_id, r.text) for r in cleaned.collect()) == want
    kept = [r.doc_id for r in corpus_pipeline.without_near_duplicates(spark, cleaned, SF_DIR).collect()]
    assert [d for d in kept if d is not None and d < 100] == [0]


def test_main_text_is_the_article(spark):
    pages = spark.read.parquet(f"{SF_DIR}/pages.parquet")
    html_of = {r.page_id: r.html for r in pages.collect()}
    for row in queries.op3_main_text(spark, SF_DIR).collect():
        inside = re.search(r"<article>(.*?)(</article>|\Z)", html_of[row.page_id], re.S)[1]
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>", " ", b)).split()) for b in re.split(r"</?p>|</?h1>", inside)]
        assert row.text == "\n".join(b for b in blocks if b) and row.n_chars == len(row.text)
    weights = main_text.learn_weights(pages.select("page_id", "html", F.lit(1).alias("kind"), F.lit(2).alias("inside")))
    assert all(w > 0 if k.startswith("word") else w < 0 for k, w in weights.items())
    page = ('<body class="has-sidebar"><header>Site name</header><nav><a>one</a> two three</nav><div class="cookie-notice">We use cookies for many good reasons here</div>'
            "<h1>A &lt;title&gt;</h1><p>First   para with <i>some</i>\nwords.<p>Second.</p><div class='comments'><p>I am a reader and I write a lot of words here</p></div><footer>end</footer><p unfin")
    assert main_text.extract(page, {}) == "A <title>\nFirst para with some words.\nSecond."
    assert main_text.extract(None, {}) == main_text.extract("", weights) == main_text.extract("<script>if (a<b) x</script>", weights) == ""
    assert main_text.extract("<p>" + LONG + "</p>", weights) == LONG.strip()
    empty = spark.createDataFrame([(1, None), (1, ""), (None, "<p>x")], "page_id long, html string")
    assert sorted(r[0] for r in empty.select(main_text.extract_column(spark, F.col("html"), main_text.learn_weights(empty))).collect()) == ["", "", "x"]


@pytest.mark.parametrize("named", ["layout with-sidebar", "content no-sidebar", "layout-has-sidebar", "post comments-open", "entry share", "content sidebar-right", "page no-related ads-disabled"])
@pytest.mark.parametrize("tag", ["div", "article"])
def test_layout_words_beside_content_hide_no_text(named, tag):
    page = f"<body><nav>one two</nav><div class='{named}'><{tag}><p>The text of the page, with several words.<p>More of it.</{tag}><div class='sidebar'>links and links</div></div></body>"
    assert main_text.extract(page, {}) == "The text of the page, with several words.\nMore of it."


@pytest.mark.parametrize("named", ["sidebar", "comments", "comments-wrapper", "main-sidebar", "comments container", "related-posts", "post-share", "content ads", "page-nav", "cookie-notice open"])
def test_furniture_named_with_a_content_word_stays_hidden(named):
    assert main_text.extract(f"<body><p>The text.</p><div class='{named}'>words of no text</div></body>", {}) == "The text."


ARTICLE = ("<article><h1>T</h1><h2 id='social-history'>Social history</h2><p>one two three</p><h2 id='related-work'>Related work</h2><p>more words here</p>"
           "<p class='note alert-level'>An alert level of four.</p><section id='comments-on-theory'><p>A section on theory.</p></section></article>")


@pytest.mark.parametrize("learned", [False, True])
def test_an_article_keeps_all_its_text(spark, learned):
    weights = main_text.learn_weights(spark.read.parquet(f"{SF_DIR}/pages.parquet")) if learned else {}
    whole = "T\nSocial history\none two three\nRelated work\nmore words here\nAn alert level of four.\nA section on theory."
    assert main_text.extract(f"<body><nav>menu</nav>{ARTICLE}<footer>end</footer></body>", weights) == whole
    parts = "<article><p>Before.</p><div class='{}'>words of no text</div><p>After it.</p></article>"
    for named in ("ad", "related-posts", "ad-slot", "comments", "newsletter-box", "share-buttons"):
        assert main_text.extract(parts.format(named), weights) == "Before.\nAfter it.", named
    for named in ("social-history", "alert-level", "search-theory", "ad-hoc"):
        assert main_text.extract(parts.format(named), weights) == "Before.\nwords of no text\nAfter it.", named
    assert main_text.extract("<article><p>Let <math><mi>x</mi><mo>+</mo><mn>1</mn></math> be.</p><xmp>raw text</xmp><object>shown instead</object></article>", weights) == "Let x+1 be.\nraw text\nshown instead"
    two = "<article><p>The first one.</p></article><p>Between.</p><div class='ad'>buy</div><article><p>The second one.</p></article><footer>f</footer>"
    assert main_text.extract(two, weights) == "The first one.\nThe second one."
    assert main_text.extract("<p>a &am<b>p;</b> b &amp;lt; c &lt;</p>", weights) == "a &amp; b &lt; c <"


def test_time_grows_with_the_page_and_not_with_its_depth():
    def seconds(n):
        began = time.process_time()
        assert main_text.extract("<article>" + "<span>word " * n + "</article>", {}).count("word") == n
        return time.process_time() - began

    seconds(1000)
    assert seconds(100_000) < 5


def plain_successors(frame):
    """Rows of each document with its successor by a plain sort."""
    rows = [(r.doc_id, r.text or "") for r in frame.select("doc_id", "text").collect()]
    ties = dict(zip([t for _, t in rows], [r[0] for r in frame.select(F.xxhash64(F.coalesce("text", F.lit("")))).collect()], strict=True))
    rows.sort(key=lambda r: (r[0] is None, -(r[0] or 0), ties[r[1]], r[1]))
    want = Counter()
    for k, (doc_id, text) in enumerate(rows):
        after = rows[(k + 1) % len(rows)][1]
        third = len(text) // 3
        edited = text[:len(text) - third] + after[:third]
        a, b, c = map(fingerprints.signature, (text, edited, after))
        want[doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), fingerprints.written(a), fingerprints.written(b), fingerprints.likeness(a, b), fingerprints.likeness(a, c)] += 1
    return want


def test_fingerprints_follow_the_successor(spark, odd, documents):
    for frame in (documents, odd, clashing(odd), odd.limit(0), odd.filter("doc_id = 7")):
        assert Counter(map(tuple, fingerprints.compare_with_successor(frame).collect())) == plain_successors(frame)


def test_an_id_on_many_rows_is_walked_through_in_several_runs(spark, monkeypatch):
    monkeypatch.setattr(fingerprints, "RUN_ROWS", 3)
    monkeypatch.setattr(fingerprints, "MAX_CUTS", 16)
    rows = [(i - 20, f"text number {i}") for i in range(40)] + [(5, f"one of many under an id {i}") for i in range(80)] + [(None, f"without an id {i}") for i in range(50)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert Counter(map(tuple, fingerprints.compare_with_successor(frame).collect())) == plain_successors(frame)
    own = fingerprints.runs(frame).filter("NOT guest")
    assert own.filter("doc_id = 5").select("run").distinct().count() >= 8 and own.filter("doc_id IS NULL").select("run").distinct().count() >= 8
    assert max(r["count"] for r in own.groupBy("run").count().collect()) <= 16


def test_a_long_text_is_parsed_with_one_dictionary():
    import random

    words = ["".join(random.Random(i).choices("etaoinshrdlucmf", k=3 + i % 6)) for i in range(4000)]
    text = " ".join(random.Random(5).choices(words, k=330_000))
    assert len(text) > 2 * fingerprints.STEP and fingerprints.written(fingerprints.signature(text)) == plain_fingerprint(text)


def test_successors_of_the_least_and_greatest_ids(spark):
    rows = [(-(1 << 63), "the least id of all"), ((1 << 63) - 1, "the greatest id of all"), (0, "in between"), (None, "without one")]
    found = {r.doc_id: r.edited_sha256 for r in fingerprints.compare_with_successor(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    text, after = dict(rows), {(1 << 63) - 1: 0, 0: -(1 << 63), -(1 << 63): None, None: (1 << 63) - 1}
    assert found == {d: hashlib.sha256((t[:len(t) - len(t) // 3] + text[after[d]][:len(t) // 3]).encode()).hexdigest() for d, t in rows}


def test_runs_hand_over_across_their_ends(spark, monkeypatch):
    monkeypatch.setattr(fingerprints, "RUN_ROWS", 3)
    frame = spark.range(40).select((F.col("id") * 7).alias("doc_id"), F.concat(F.lit("text number "), F.col("id")).alias("text"))
    rows = fingerprints.compare_with_successor(frame).collect()
    text = {7 * i: f"text number {i}" for i in range(40)}
    for r in rows:
        own, after = text[r.doc_id], text[r.doc_id - 7 if r.doc_id else 273]
        assert r.edited_sha256 == hashlib.sha256((own[:len(own) - len(own) // 3] + after[:len(own) // 3]).encode()).hexdigest()
    assert len(rows) == 40


def brute_components(rows, width, percent):
    sets = []
    for doc_id, text in rows:
        words = WORDS.findall((text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")))
        sets.append((doc_id, {tuple(words[i:i + width]) for i in range(max(1, len(words) - width + 1))} if words else set()))
    root = {d: d for d, _ in rows if d is not None}

    def find(d):
        while root[d] != d:
            d = root[d]
        return d

    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            if a is not None and b is not None and x and y and 100 * len(x & y) >= percent * len(x | y):
                low, high = sorted((find(a), find(b)))
                root[high] = low
    return Counter((d, len(s), None if d is None else find(d), d is None or find(d) == d) for d, s in sets)


def test_near_duplicates_equal_all_pairs(spark, odd, documents):
    words = [f"w{i}" for i in range(60)]
    chain = [(1000 - i, " ".join(words[i:] + [f"x{j}" for j in range(i)]), "en", "a", 0) for i in range(12)]
    spread = [(2000 + i, " ".join(f"n{i}-{j}" if (j * 7 + i * 13) % 23 < i % 6 else w for j, w in enumerate(words)), "en", "a", 0) for i in range(60)]
    same_id = [(1, "another text under a known id, of some length", "en", "a", 0)]
    frame = spark.createDataFrame(ODD + chain + spread + same_id, SCHEMA)
    for given, width in ((frame, 4), (clashing(frame), 5), (odd.limit(0), 5), (documents, 5)):
        rows = [tuple(r) for r in given.select("doc_id", "text").collect()]
        got = near_dedup.near_duplicates(given, width)
        assert Counter(map(tuple, got.select("doc_id", "n_shingles", "component_id", "kept").collect())) == brute_components(rows, width, 80)
    kept = near_dedup.keep_first(clashing(documents))
    assert kept.columns == clashing(documents).columns and kept.count() == sum(n for k, n in brute_components([tuple(r) for r in documents.select("doc_id", "text").collect()], 5, 80).items() if k[3])


def test_one_row_of_each_group_is_kept_whatever_its_id(spark):
    words = [f"w{i}" for i in range(60)]
    text = lambda edit: " ".join([*words[:edit], "edited", *words[edit + 1:]])
    rows = [(None, text(0)), (None, text(0)), (None, text(59)), (3, text(1)), (3, text(1)), (9, text(58)), (None, "a text of nobody"), (None, "a text of nobody"), (4, "another"), (4, "and another, under the same id"), (5, None), (6, None)]
    frame = spark.createDataFrame([(d, t, "en", f"s{i}", 0) for i, (d, t) in enumerate(rows)], SCHEMA)
    got = near_dedup.keep_first(frame)
    assert got.columns == frame.columns
    assert Counter((r.doc_id, r.text) for r in got.collect()) == Counter({(3, text(1)), (None, "a text of nobody"), (4, "another"), (4, "and another, under the same id"), (5, None), (6, None)})


def test_documents_whose_hashes_are_equal_stay_apart(spark, monkeypatch):
    words = [f"w{i}" for i in range(60)]
    rows = [(i, f"a text of its own {i} {i * i}", "en", "a", 0) for i in range(12)] + [(20, " ".join(words), "en", "a", 0), (21, " ".join([*words[:59], "last"]), "en", "a", 0), (3, "a text of its own 3 9", "en", "a", 0)]
    frame = spark.createDataFrame(rows, SCHEMA).withColumn("low", F.lit(1))
    monkeypatch.setattr(near_dedup, "document_key", lambda: F.pmod(F.xxhash64("doc_id", "text"), F.lit(3)).alias("key"))
    got = near_dedup.keep_first(frame)
    assert got.columns == frame.columns and sorted(r.doc_id for r in got.collect()) == [*range(12), 20]


def test_components_of_long_paths(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 103), (103, 101)] + [(7, 7)]
    got = {r.node: r.component for r in near_dedup.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100, 103: 100}


def test_components_run_no_round_on_stars(spark, monkeypatch):
    written = []
    monkeypatch.setattr(near_dedup, "held", lambda frame, name: (written.append(name), common.held(frame, name))[1])
    for edges, want, rounds in (
            ([], {}, 0), ([(1, 5), (6, 1), (2, 7), (3, 3)], {1: 1, 5: 1, 6: 1, 2: 2, 7: 2}, 0), ([(5, 1), (5, 2)], {1: 1, 2: 1, 5: 1}, 1), ([(1, 2), (2, 3)], {1: 1, 2: 1, 3: 1}, 1),
            ([(1, 3), (2, 3), (2, 4), (8, 9)], {1: 1, 2: 1, 3: 1, 4: 1, 8: 8, 9: 8}, 2)):
        written.clear()
        got = near_dedup.components(spark.createDataFrame(edges, "a long, b long")).collect()
        assert sorted((r.node, r.component) for r in got) == sorted(want.items())
        assert written.count("edges") == 1 and len(written) <= 1 + 2 * rounds


def test_near_dedup_writes_no_step_that_holds_nothing(spark, monkeypatch):
    written = []
    monkeypatch.setattr(near_dedup, "held", lambda frame, name: (written.append(name), common.held(frame, name))[1])
    base = [f"w{k}" for k in range(60)]
    frame = spark.createDataFrame([(k, " ".join(f"{k}x{w}" for w in base)) for k in range(3)] + [(k, " ".join([*base[:-1], f"end{k}"])) for k in range(3, 6)], "doc_id long, text string")
    assert sorted(r.doc_id for r in near_dedup.keep_first(frame).collect()) == [0, 1, 2, 3]
    assert written.count("edges") == 1 and not {"second-links", "shared-nodes", "repeated-nodes"} & set(written)


def test_driver_gets_trained_weights_and_no_sample(spark, documents, monkeypatch):
    def refused(*_):
        raise AssertionError("rows of the sample came to the driver")

    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    sample = quality_classifier.sample_features(quality_classifier.training_sample(documents.select("doc_id", "text"), labels, F.lit(True)))
    rows = sorted(map(tuple, sample.collect()))
    want = quality_classifier.fit([(np.frombuffer(r[2], "<u2"), np.frombuffer(r[3], "<f4")) for r in rows], [r[1] for r in rows])
    monkeypatch.setattr(type(documents), "toLocalIterator", refused)
    weights, bias = quality_classifier.train(documents, labels, F.lit(True))
    assert np.allclose(weights, want[0], atol=1e-3) and bias == pytest.approx(want[1], abs=1e-3)


def test_a_held_step_is_data_only(spark):
    path = common.held(spark.range(3).toDF("a"), "test-held").inputFiles()[0].removeprefix("file:")
    assert {p.name for p in Path(path).parent.iterdir() if not p.name.startswith((".", "part-"))} == set()


def test_quality_is_learned_and_whole_texts_scored(spark, odd, documents):
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    rows = queries.op6_quality_classifier(spark, SF_DIR).join(labels, "doc_id").filter("held_out").collect()
    assert sum(r.predicted == r.quality for r in rows) >= 0.9 * len(rows) and all(0 <= r.score <= 1 for r in rows)
    model = quality_classifier.train(documents, labels, F.lit(True))
    assert all(0 <= r[0] <= 1 for r in odd.select(quality_classifier.score_column(spark, F.col("text"), model)).collect())
    features, filler = quality_classifier.Features(), " ".join(documents.filter("lang = 'en'").limit(3).toPandas()["text"])
    assert quality_classifier.score(filler + " $$$ ### &&&" * 200_000, model, features) < quality_classifier.score(filler, model, features)
    ones, none = labels.withColumn("quality", F.lit(1)), labels.limit(0)
    for given, want in ((ones, 1.0), (ones.withColumn("quality", F.lit(0)), 0.0), (none, 0.5)):
        model = quality_classifier.train(documents, given, F.lit(True))
        assert model == want and {r[0] for r in odd.select(quality_classifier.score_column(spark, F.col("text"), model)).collect()} == {want}


def plain_features(text):
    """Row numbers of all features of a text, by the definition: words, a word like its neighbour, runs of 3 and 4 characters."""
    def row(h, kind):
        mixed = (h + kind) * 0x9E3779B97F4A7C15 % (1 << 64)
        return ((mixed ^ mixed >> 29) * 0xBF58476D1CE4E5B9 % (1 << 64)) >> 48

    words = WORDS.findall(text)
    found = [row(sum((ord(c) + 1) * pow(0x100000001B3, k, 1 << 64) for k, c in enumerate(w)) % (1 << 64), 0) for w in words]
    found += [row(1, 1) for a, b in zip(words, words[1:]) if a == b]
    for n in (3, 4):
        for i in range(len(text) - n + 1 if words else 0):
            h = 0
            for c in text[i:i + n]:
                h = ((h << 16) + ord(c)) % (1 << 64)
            found.append(row(h, n))
    return Counter(found)


def test_classifier_equals_plain_features_and_descent(spark, documents, monkeypatch):
    import math

    import numpy as np

    texts = [r.text or "" for r in documents.orderBy("doc_id").limit(12).collect()] + ["", "the the the 日本 😀 \t x"]
    plain = [plain_features(t) for t in texts]
    rows = [quality_classifier.counted(t, quality_classifier.Features()) for t in texts]
    for (index, share), want in zip(rows, plain, strict=True):
        assert dict(zip(index.tolist(), share.tolist(), strict=True)) == pytest.approx({k: n / want.total() for k, n in want.items()})
    monkeypatch.setattr(quality_classifier, "UPDATES", 60)
    labels = [i % 2 for i in range(len(texts))]
    weights, bias = quality_classifier.fit(rows, labels)
    # The same descent, one feature after the other.
    random, size = np.random.default_rng(quality_classifier.SEED), quality_classifier.DIMENSION
    vectors = random.uniform(-1 / size, 1 / size, (quality_classifier.BUCKETS, size)).tolist()
    layer, offset, done = [[0.0, 0.0] for _ in range(size)], [0.0, 0.0], 0
    while done < 60:
        for i in random.permutation(len(texts)):
            rate, shares = 3.0 * max(0.02, 1 - done / 60), {k: n / plain[i].total() for k, n in plain[i].items()}
            average = [sum(s * vectors[k][d] for k, s in shares.items()) for d in range(size)]
            powers = [math.exp(sum(average[d] * layer[d][c] for d in range(size)) + offset[c]) for c in (0, 1)]
            error = [powers[c] / sum(powers) - (labels[i] == c) for c in (0, 1)]
            back = [sum(layer[d][c] * error[c] for c in (0, 1)) for d in range(size)]
            for d in range(size):
                for c in (0, 1):
                    layer[d][c] -= rate * average[d] * error[c]
            offset = [offset[c] - 0.01 * rate * error[c] for c in (0, 1)]
            for k, s in shares.items():
                vectors[k] = [vectors[k][d] - rate * s * back[d] for d in range(size)]
            done += 1
    used = sorted(set().union(*plain))
    want = {k: sum(vectors[k][d] * (layer[d][1] - layer[d][0]) for d in range(size)) for k in used}
    assert [float(weights[k]) for k in used] == pytest.approx([want[k] for k in used], abs=2e-3) and bias == pytest.approx(offset[1] - offset[0], abs=1e-4)
    # Scores in Spark are the softmax over whole texts.
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    scores = dict(map(tuple, frame.select("doc_id", quality_classifier.score_column(spark, F.col("text"), (weights, bias))).collect()))
    for i, counts in enumerate(plain):
        mean = sum(float(weights[k]) * n for k, n in counts.items()) / max(1, counts.total())
        assert scores[i] == pytest.approx(1 / (1 + math.exp(-bias - mean)), abs=1e-6)


def test_whole_texts_are_learned_from_and_one_row_of_an_id(spark):
    long_ = "start " * 30_000 + "the end of a long text"
    docs = spark.createDataFrame([(1, long_), (1, "another row under this id"), (2, "good"), (None, "nobody"), (4, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 0), (1, 1), (2, 1), (4, 1), (9, 1), (None, 1)], "doc_id long, quality int")
    got = quality_classifier.training_sample(docs, labels, F.lit(True)).collect()
    least = docs.filter("doc_id = 1").orderBy(F.xxhash64("text")).first().text
    assert sorted((r.doc_id, r.quality, r.text) for r in got if r.doc_id != 4) == [(1, 0, least), (2, 1, "good")] and [r.text for r in got if r.doc_id == 4] == [None]
    only = quality_classifier.sample_features(quality_classifier.training_sample(docs.filter(F.length("text") > 100), labels, F.lit(True))).first()
    assert len(only.rows) // 2 == len(plain_features(long_))


def test_feature_steps_lose_nothing(monkeypatch):
    text = "alpha beta beta gamma\n" * 40
    whole = Counter(int(r) for part in quality_classifier.Features().rows(text) for r in part)
    monkeypatch.setattr(quality_rules, "STEP", 7)
    assert sum(len(p) for p in quality_rules.gram_buckets(text)) == len(text) - 2
    assert sum(whole.values()) > len(text)


def test_mix_comes_near_its_targets(spark, odd, documents):
    for frame in (documents, odd, clashing(odd), odd.limit(0)):
        rows = mixing.mix(frame).collect()
        assert len(rows) == frame.count() and all(r.taken <= 3 * r.size and r.target <= 3 * r.source_size + 1e-6 for r in rows)
        repeated = mixing.repeat(frame)
        assert repeated.columns == frame.columns and repeated.count() == sum(r.copies for r in rows)
        assert sorted(map(tuple, mixing.mix(frame).select("size", "taken").collect())) == sorted((r.size, r.taken) for r in rows)
    rows = mixing.mix(documents).join(documents.select("doc_id", "source"), "doc_id").groupBy("source").agg(F.sum("taken").alias("taken"), F.first("target").alias("target"), F.max("size").alias("longest")).collect()
    assert all(abs(r.taken - r.target) <= r.longest for r in rows)


def test_targets_fill_up_by_weight(spark):
    sizes = {"a": 10, "b": 100, "c": 1000, "d": 0, None: 50}
    frame = spark.createDataFrame([(s, n) for s, n in sizes.items()], "source string, size long")
    order = ["a", "b", "c", "d", None]
    weights = dict(zip(order, (5, 2, 1, 5, 2), strict=True))
    limit, target, free, left = {s: 3 * sizes[s] for s in order}, {}, set(order), 1160.0
    while over := {s for s in free if left * weights[s] / sum(weights[x] for x in free) > limit[s]}:
        for s in over:
            target[s] = limit[s]
        left, free = 1160 - sum(target.values()), free - over
    target |= {s: left * weights[s] / sum(weights[x] for x in free) for s in free}
    assert {r.source: pytest.approx(r.target) for r in mixing.targets(frame).collect()} == target


def test_targets_of_many_sources_take_time_in_proportion(spark):
    many = spark.range(40_000).select(F.concat(F.lit("s"), F.col("id")).alias("source"), (F.col("id") % 997).alias("size"))
    began = time.time()
    found = mixing.targets(many).agg(F.sum("target"), F.sum("source_size"), F.count(F.lit(1))).first()
    assert found[0] == pytest.approx(found[1]) and found[2] == 40_000 and time.time() - began < 15


def test_rules_equal_plain_counts(spark, odd, documents):
    def plain(text):
        text = text or ""
        words, lines = WORDS.findall(text), text.split("\n")
        windows = Counter(tuple(words[i:i + 8]) for i in range(len(words) - 7))
        covered = {j for i in range(len(words) - 7) if windows[tuple(words[i:i + 8])] > 1 for j in range(i, i + 8)}
        doubled = sum(bool(WORDS.search(line)) and line in lines[:i] for i, line in enumerate(lines))
        return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), doubled, len(covered)

    short = spark.createDataFrame([(r[0], r[1] if r[1] != LONG else LONG[:5000]) for r in ODD] + [(9, "a b c d e f g h " * 3 + "x\nx\n x\nx"), (10, "<b>|# " * 30)], "doc_id long, text string")
    for frame in (short, documents.select("doc_id", "text"), short.limit(0)):
        ratios = quality_rules.log_ratios(*quality_rules.gram_counts(frame, F.col("doc_id") % 2 == 0))
        got = quality_rules.judge(spark, frame, ratios).collect()
        want = Counter((r.doc_id, *plain(r.text)) for r in frame.collect())
        assert Counter(tuple(r)[:6] for r in got) == want
        assert all(r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words) and not (r.kept and r.base_failed) for r in got)
        assert all(r.kept == (r.score >= quality_rules.THRESHOLD) for r in got if not r.base_failed)
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}
    judged = queries.op9_quality_rules(spark, SF_DIR).collect()
    assert all(r.kept for r in judged if labels.get(r.doc_id) == 1 and r.n_words >= 20 and not r.base_failed)


def test_shards_match_the_mixture(spark, odd, documents):
    for frame, shards in ((documents, 40), (odd, 3), (clashing(odd), 40), (odd.limit(0), 5)):
        rows = sharding.interleave(frame, shards).collect()
        by = defaultdict(list)
        for r in rows:
            by[r.shard].append(r.slot)
        assert len(rows) == frame.count() and all(sorted(v) == list(range(len(v))) for v in by.values())
        counts = [len(by[s]) for s in range(shards)]
        assert max(counts) - min(counts) <= 1
        texts = Counter((r.doc_id, len((r.text or "").encode()) + 16, zlib.crc32((r.text or "").encode())) for r in frame.select("doc_id", "text").collect())
        assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == texts
    rows = sharding.interleave(documents, 4).collect()
    total = Counter(r.source for r in rows)
    for shard in range(4):
        here = Counter(r.source for r in rows if r.shard == shard)
        assert all(abs(here[s] - n / 4) <= 1 for s, n in total.items())


def test_shards_equal_plain_ranks(spark, odd, documents):
    from fractions import Fraction

    for frame, shards in ((documents, 40), (odd, 3)):
        order = F.xxhash64(F.lit(sharding.SEED), F.coalesce(F.col("doc_id").cast("string"), F.coalesce("text", F.lit(""))))
        rows = [(r.source, r.order, (r.doc_id is not None, r.doc_id or 0), zlib.crc32((r.text or "").encode()), len((r.text or "").encode()) + 16, r.doc_id) for r in frame.select("doc_id", "text", "source", order.alias("order")).collect()]
        strata = defaultdict(list)
        for row in rows:
            strata["none" if row[0] is None else f"source {row[0]}"].append(row)
        ranked = [(Fraction(2 * rank + 1, 2 * len(found)), name, *row[1:]) for name, found in strata.items() for rank, row in enumerate(sorted(found, key=lambda r: r[1:5]))]
        ranked.sort(key=lambda r: r[:6])
        want, slots = Counter(), Counter()
        for place, (fraction, _, _, _, crc, size, doc_id) in enumerate(ranked):
            shard = place * shards // len(ranked)
            want[doc_id, size, crc, float(fraction), shard, slots[shard]] += 1
            slots[shard] += 1
        got = sharding.interleave(frame, shards).select("doc_id", "size", "text_crc32", "fraction", "shard", "slot").collect()
        assert Counter(map(tuple, got)) == want


def plain_fingerprint(text):
    """Phrases by a set of byte strings, hashed by the definition; the least hash of each of 128 bins, its last 16 bits in hex."""
    data, phrases, start = text.encode(), set(), 0
    for end in range(1, len(data) + 1):
        if data[start:end] not in phrases:
            phrases.add(data[start:end])
            start = end
    least = {}
    for phrase in phrases:
        h = sum((byte + 1) * pow(fingerprints._BASE, k, 1 << 64) for k, byte in enumerate(phrase)) % (1 << 64)
        for factor in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB):
            h = (h ^ h >> 31) * factor % (1 << 64)
        least[h >> 57] = min(h, least.get(h >> 57, h))
    return "".join(f"{least[b] & 0xFFFF:04x}" if b in least else "----" for b in range(128))


def test_a_tried_parse_leaves_the_tree_as_it_was():
    parse = fingerprints.Parse().feed("abracadabra abracadabra")
    before, log = repr(parse.root), []
    assert (parse.signature_with(" abra cadabra") == fingerprints.signature("abracadabra abracadabra abra cadabra")).all() and repr(parse.root) == before
    parse.feed(" abra", log)
    assert log and all(isinstance(node, dict) for node in log)


def test_no_search_for_cycles_while_trees_are_built():
    assert gc.isenabled()
    with pytest.raises(ValueError), fingerprints.no_cycle_search():
        assert not gc.isenabled()
        raise ValueError
    assert gc.isenabled()


def test_fingerprints_equal_a_plain_parse(documents):
    texts = [r.text or "" for r in documents.limit(25).collect()] + ["", "a", "aaaaaaaaaa" * 30, "Ünï 日本 😀 x" * 20]
    for text in texts:
        assert fingerprints.written(fingerprints.signature(text)) == plain_fingerprint(text)
    agree = lambda a, b: [a[i:i + 4] == b[i:i + 4] for i in range(0, 512, 4) if a[i:i + 4] != "----" or b[i:i + 4] != "----"]
    for one, other in zip(texts, texts[1:]):
        same = agree(plain_fingerprint(one), plain_fingerprint(other))
        assert fingerprints.likeness(fingerprints.signature(one), fingerprints.signature(other)) == (pytest.approx(sum(same) / len(same)) if same else 1.0)


def test_log_ratio_equals_plain_counts(spark, documents):
    import math

    rows = [(r.doc_id, r.text or "") for r in documents.select("doc_id", "text").limit(60).collect()]
    grams = {d: [int(g) for found in quality_rules.gram_buckets(t, quality_rules.BUCKETS) for g in found] for d, t in rows}
    trusted, every = Counter(), Counter()
    for d, found in grams.items():
        every.update(found)
        trusted.update(found if d % 3 == 0 else [])
    size, prior = quality_rules.BUCKETS, quality_rules.PRIOR
    total = [sum(c.values()) + size * prior for c in (trusted, every)]
    ratio = lambda g: math.log((trusted[g] + prior) / total[0]) - math.log((every[g] + prior) / total[1])
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    judged = quality_rules.judge(spark, frame, quality_rules.log_ratios(*quality_rules.gram_counts(frame, F.col("doc_id") % 3 == 0))).collect()
    for r in judged:
        want = sum(map(ratio, grams[r.doc_id])) / max(1, len(grams[r.doc_id]))
        assert r.score == pytest.approx(want, abs=1e-4) and (r.kept == (not r.base_failed and r.score >= quality_rules.THRESHOLD))
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}
    rejected = [r.doc_id for r in queries.op9_quality_rules(spark, SF_DIR).collect() if not r.base_failed and not r.kept]
    assert rejected and all(labels.get(d) != 1 for d in rejected)


def test_pipeline_rows_equal_a_chain_of_plain_steps(spark, documents):
    import duckdb

    names = documents.columns
    kept = corpus_pipeline.held(corpus_pipeline.good_quality(spark, documents, SF_DIR), "test-quality")
    component = {r.same: r.component for r in copies.copy_groups(kept).collect()}
    same = {r.text: r.same for r in kept.select("text", line_dedup.text_class()).collect()}
    rows = [(r.doc_id, r.text, r.source) for r in kept.collect()]
    source = {r[0]: r[2] for r in rows}
    cleaned = brute_lines(rows, line_dedup.MIN_SITES, lambda text: component.get(same[text], same[text]))
    texts = [(d, t) for d, t in cleaned.elements()]
    firsts = {d for (d, _, _, first), n in brute_components(texts, 5, 80).items() if first}
    single = spark.createDataFrame([(t, "", source[d], 0, d) for d, t in texts if d in firsts], "text string, lang string, source string, n_chars long, doc_id long").toPandas()
    con = duckdb.connect()
    con.register("documents", single)
    times = {r[0]: r[1] for r in con.execute(f"SELECT doc_id, copies FROM ({mixing.SQL})").fetchall()}
    ranks = {token: rank for rank, token in enumerate(byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")))}
    other = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = Counter()
    for d, t in texts:
        if d in firsts:
            ids = tuple(other.encode_ordinary(t or ""))
            want[d, source[d], len(ids), ids] += times[d]
    got = Counter((r.doc_id, r.source, r.n_tokens, tuple(r.ids)) for r in corpus_pipeline.run(spark, SF_DIR).collect())
    assert got == +want and len(got) > 50 and names[0] == "doc_id"


def test_stages_take_effect_on_all_that_came_before(spark, documents):
    docs, sizes = documents, []
    for name, stage in corpus_pipeline.STAGES:
        after = corpus_pipeline.held(stage(spark, docs, SF_DIR), "test-stage")
        if name != "byte bpe":
            assert after.columns == documents.columns
        sizes.append(after.count())
        docs = after
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}
    assert sizes[0] < documents.count() and sizes[1] == sizes[0] and sizes[2] < sizes[1] and sizes[4] == sizes[3]
    kept = {r.doc_id for r in corpus_pipeline.good_quality(spark, documents, SF_DIR).collect()}
    assert sum((d in kept) == bool(q) for d, q in labels.items()) >= 0.97 * len(labels)
    assert corpus_pipeline.run(spark, SF_DIR).count() == sizes[-1]


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stages_take_odd_and_empty_tables(spark, odd, name):
    stage = dict(corpus_pipeline.STAGES)[name]
    for frame in (odd, clashing(odd), odd.limit(0)):
        got = stage(spark, frame, SF_DIR)
        assert got.count() <= 3 * frame.count()
        if name != "byte bpe":
            assert got.columns == frame.columns


def test_lines_are_sketched_before_they_are_shuffled(spark, documents, monkeypatch):
    """With and without a broadcast, a hot line sends one sketch per task, and the result is the same."""
    rows = line_dedup.listed(documents)
    for most in (1_000_000, -1):
        monkeypatch.setattr(line_dedup, "small_or_shuffled", lambda frame, most=most: common.small_or_shuffled(frame, most))
        found = rows.select(F.xxhash64("site").alias("site"), F.pmod("key", F.lit(line_dedup.SALTS)).cast("int").alias("salt"), F.explode("hashes").alias("line"))
        plan = line_dedup.among(found, found.select("line").distinct()).groupBy("line").agg(F.hll_sketch_agg("site"))._jdf.queryExecution().executedPlan().toString()
        sketch = plan.index("partial_hll_sketch_agg")
        assert "Exchange hashpartitioning(line" in plan[:sketch]
        got = line_dedup.remove_boilerplate(documents).select("doc_id", "text", "source").collect()
        assert Counter((r.doc_id, r.text) for r in got) == brute_lines([tuple(r) for r in documents.select("doc_id", "text", "source").collect()], line_dedup.MIN_SITES)


def test_copy_groups_hold_near_copies_and_not_pages_that_share_lines(spark):
    words = lambda k, n=200: [f"w{k}x{j * j % 977}" for j in range(n)]
    edited = lambda k, place: " ".join(w if i != place else "edit" for i, w in enumerate(words(k)))
    near = [(k * 100 + p, edited(k, 7 * p)) for k in range(3) for p in range(25)]
    pages = [(1000 + i, f"page {i} tells of its own matter number {i * i} and {i}\nAll rights reserved by the owners of this site and of its pages") for i in range(40)]
    rows = near + [(i + 5000, t) for i, t in near] + pages + [(9001, None), (9002, ""), (9003, "one"), (9004, " one\t"), (None, "two words")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    found = frame.select("doc_id", line_dedup.text_class()).join(copies.copy_groups(frame), "same").collect()
    members = defaultdict(set)
    for r in found:
        members[r.component].add(r.doc_id)
    want = [{i for i, _ in near if i // 100 == k} | {i + 5000 for i, _ in near if i // 100 == k} for k in range(3)] + [{9003, 9004}]
    assert sorted(members.values(), key=min) == sorted(want, key=min)
    assert copies.copy_groups(frame.limit(0)).collect() == []
    plan = copies.copy_groups(frame)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
