"""Operators on texts, tokens and pages, against brute force and the original libraries."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from changewatch.llm import chat, common, packing, pages, pieces, quality, repeats, tokens

PARTS = ["a", "b", "the ", "  ", "\n", "é", "▁", "漢", "hello.", " wor", "\r", "<s>", "\t", "x" * 30, " ", "!", "'s", "12", "İ", "Σ",
         "é", " ", "...", ",", "ß", "\x1c", "Á ", "<|endoftext|>", "\U0001f600"]


def mess(seed, most=60):
    rng = random.Random(seed)
    return "".join(rng.choice(PARTS) for _ in range(rng.randint(0, most)))


def frame(spark, rows):
    """With columns whose names clash with those of results."""
    return spark.createDataFrame([(*r, 1, "x", 2) for r in rows], "doc_id long, text string, n_bytes int, key string, length int")


ODD = [(1, None), (2, ""), (3, " "), (None, "null id"), (4, "twice"), (4, "twice"), (5, "long " * 40000), (6, "z" * 70000)]


def brute_repeats(rows, size):
    seen, out = {}, []
    for ident, text in sorted(rows, key=lambda r: r[0]):
        for at in range(len(text) - size + 1):
            seen.setdefault(text[at:at + size], ident)
    for ident, text in rows:
        covered = bytearray(len(text))
        for at in range(len(text) - size + 1):
            if seen[text[at:at + size]] < ident:
                covered[at:at + size] = b"\1" * size
        kept = bytes(b for b, c in zip(text, covered) if not c)
        runs = sum(1 for i in range(len(text)) if covered[i] and (i == 0 or not covered[i - 1]))
        out.append((ident, len(text), sum(covered), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


@pytest.mark.parametrize("size,hot", [(50, 2000), (50, 2), (12, 2000), (30, 1)])
def test_repeats_against_brute_force(spark, monkeypatch, size, hot):
    monkeypatch.setattr(repeats, "CHUNK", 3000)
    monkeypatch.setattr(repeats, "BUCKET", 9000)
    rng = random.Random(size + hot)
    lines = ["".join(rng.choice("abcdé ") for _ in range(rng.randint(5, 140))) for _ in range(40)]
    rows = [(i, "\n".join(rng.choice(lines) for _ in range(rng.randint(0, 6)))) for i in range(60)]
    rows += [(100, "ab" * 90), (101, "ba" * 90), (102, "ab" * 90), (103, None), (104, ""), (104, ""), (105, rows[7][1]), (106, "x" * 49)]
    rows += [(107, "y" * 700), (108, "-" + "y" * 651 + "\0" * 300), (109, "\0" * 280 + "y" * 60), (110, "abc" * 200), (111, "cab" * 230)]
    found = repeats.digests(repeats.spans(frame(spark, rows), size, hot=hot)).collect()
    assert sorted(map(tuple, found)) == brute_repeats([(i, (t or "").encode()) for i, t in rows], size)


def shared_prefix(a, b):
    return next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))


@pytest.mark.parametrize("letters", ["ab", "a", "aaab", "a\0", "abcdefgh"])
def test_longest_previous_factors_against_all_pairs(letters):
    rng = random.Random(letters)
    for _ in range(60):
        texts = ["".join(rng.choice(letters) for _ in range(rng.randint(1, 50))).encode() for _ in range(rng.randint(1, 8))]
        documents = np.array([rng.choice([-1 << 63, -3, 0, 5, repeats.LAST]) for _ in texts])
        lengths = np.array([len(t) for t in texts])
        begins = np.cumsum(lengths) - lengths
        text = np.repeat(np.arange(len(texts)), lengths)
        starts = np.arange(lengths.sum())
        left = (begins + lengths)[text] - starts
        data = np.frombuffer(b"".join([*texts, b"ab\0ab\0ab"]), np.uint8)  # what follows the last end takes no part
        suffixes = [texts[t][s - begins[t]:] for t, s in zip(text, starts)]
        order, common = repeats.suffix_order(data, starts, left)
        assert [suffixes[i] for i in order] == sorted(suffixes)
        assert common[1:].tolist() == [shared_prefix(suffixes[a], suffixes[b]) for a, b in zip(order, order[1:])]
        assert repeats.longest_previous_factors(data, starts, left, documents[text]).tolist() == [
            max([shared_prefix(s, o) for o, d in zip(suffixes, documents[text]) if d < own], default=0)
            for s, own in zip(suffixes, documents[text])]
    empty = np.zeros(0, np.int64)
    assert len(repeats.longest_previous_factors(np.zeros(8, np.uint8), empty, empty, empty)) == 0


def test_repeats_of_null_ids_and_of_nothing(spark):
    text = "".join(random.Random(1).choice("abcdefgh") for _ in range(200))
    df = spark.createDataFrame([(None, text), (None, text), (5, text), (5, text[:100])], "doc_id long, text string")
    found = sorted((r.doc_id or 99, len(r.text), sum(s.end - s.start for s in r.removed)) for r in repeats.spans(df).collect())
    assert found == [(5, 100, 0), (5, 200, 0), (99, 200, 200), (99, 200, 200)]
    assert repeats.spans(df.where("false")).collect() == []


def test_shortened_texts_stay_texts(spark):
    shared = "é" * 40
    df = spark.createDataFrame([(1, "aé" + shared, "x", 42), (2, "bbé" + shared, "y", 43), (3, None, None, None)],
                               "doc_id long, text string, lang string, n_chars long")
    rows = {r.doc_id: r for r in repeats.shortened(df).collect()}
    assert rows[1].text == "aé" + shared and rows[2].text == "bb" and rows[2].n_chars == 2 and rows[2].lang == "y"
    assert rows[3].text == "" and repeats.cut_text("aéb", [{"start": 2, "end": 4}]) == "aé"


def test_spliced_counts_are_those_of_the_library():
    own = tokens.Counter(public_tokenizers.path("piece_bpe_32k.model"), chunk=40, overlap=4)
    assert own.stable
    texts = [mess(seed, 120) for seed in range(1500)]
    assert own.count(texts) == [len(ids) for ids in own.library.encode(texts)]


def test_token_counts_of_odd_rows(spark):
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    found = tokens.count_tokens(frame(spark, ODD), chunk=5000).collect()
    expected = sorted((i or 0, len((t or "").encode()), len(library.encode(t or ""))) for i, t in ODD)
    assert sorted((r.doc_id or 0, r.n_bytes, r.n_tokens) for r in found) == expected
    assert all(r.over_limit == (r.n_tokens > 4096) for r in found)
    assert tokens.count_tokens(frame(spark, ODD).where("false")).collect() == []


def test_sentencepiece_backend(spark):
    path = public_tokenizers.path("piece_bpe_32k.model")
    own = pieces.Backend(path)
    texts = [mess(seed) for seed in range(1500)] + ["", " ", "  ", "a ", " a"]
    found = own.encode(texts)
    assert [ids.tolist() for ids, _ in found] == own.library.encode(texts) and all(same for _, same in found)
    assert own.decode([ids for ids, _ in found]) == [text.replace("▁", " ") for text in texts]
    rows = pieces.round_trip(frame(spark, ODD[:6])).collect()
    assert len(rows) == 6 and all(r.parity and r.decoded for r in rows)
    encoded = pieces.encode(frame(spark, ODD[:6]))
    back = {r.doc_id: r.text for r in pieces.decode(encoded).collect()}
    assert back == {i: t or "" for i, t in ODD[:6]}
    assert pieces.round_trip(frame(spark, ODD).where("false")).collect() == []


def unigram_file(tmp_path):
    """A small unigram model in the file format, put together by hand."""
    def field(number, value):
        if isinstance(value, bytes):
            return bytes([number << 3 | 2, len(value)]) + value
        return bytes([number << 3, value])
    texts = [("<unk>", 0.0, 2), ("▁", -2.0, 1), ("a", -3.0, 1), ("b", -3.5, 1), ("ab", -4.0, 1), ("▁ab", -5.0, 1), ("▁a", -4.5, 1)]
    data = b"".join(field(1, field(1, t.encode()) + bytes([2 << 3 | 5]) + np.float32(s).tobytes() + field(3, k)) for t, s, k in texts)
    data += field(2, field(3, 1)) + field(3, field(1, b"identity") + field(3, 1) + field(4, 0) + field(5, 1))
    path = tmp_path / "unigram.model"
    path.write_bytes(data)
    return str(path)


def test_sentencepiece_unigram_backend(tmp_path):
    own = pieces.Backend(unigram_file(tmp_path))
    texts = ["ab", "aab b", "", "b a ab  aba"]
    assert [ids.tolist() for ids, _ in own.encode(texts)] == own.library.encode(texts)


def test_packing_covers_all_tokens(spark):
    texts = [mess(seed, 300) for seed in range(150)]
    rows = [*enumerate(texts), (200, None), (200, None), (None, "null id"), (300, "word " * 9000)]
    found = packing.pack(frame(spark, rows), size=256).collect()
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    expected = []
    for ident, text in rows:
        ids = np.array([*library.encode(text or "", add_special_tokens=False).ids, 2], "<u4")
        expected += [(ident or -1, at, min(256, len(ids) - at), zlib.crc32(ids[at:at + 256].tobytes()), len(ids)) for at in range(0, len(ids), 256)]
    assert sorted((-1 if r.doc_id is None else r.doc_id or -1, *r[1:5]) for r in found) == sorted(expected)
    filled = {}
    for r in sorted(found, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == filled.get(r.sequence_id, 0)
        filled[r.sequence_id] = r.offset + r.length
    assert sorted(filled) == list(range(len(filled))) and max(filled.values()) <= 256
    assert packing.pack(frame(spark, rows).where("false")).collect() == []


def test_patterns_use_every_length_once():
    rng = random.Random(2)
    histogram = {length: rng.randint(1, 10 ** rng.randint(1, 6)) for length in rng.sample(range(1, 4097), 900)} | {4096: 7, 1: 10}
    layout = packing.shortest_pack_first(histogram, 4096)
    used = {}
    for lengths, count in layout:
        assert sum(lengths) <= 4096 and count > 0
        for length in lengths:
            used[length] = used.get(length, 0) + count
    assert used == histogram
    total, sequences = sum(k * v for k, v in histogram.items()), sum(count for _, count in layout)
    assert total > 0.95 * 4096 * sequences
    runs = packing.slots(layout)
    assert len(runs["length"]) < 40000


def test_pages_of_many_kinds():
    shown = {
        "<p>A &amp; b</p><p> c\n d</p>": "A & b\nc d",
        "<nav><a href='/'>Home</a></nav><article><h1>T</h1><p>Body <b>text</b> here.<script>var a='<p>no</p>'</script></p>"
        "<div class='ad-box'>Buy now</div><p>More &lt;text&gt;.<section id='comments'><p>Nice</p></section></article><footer>F</footer>":
            "T\nBody text here.\nMore <text>.",
        "": "", "<p></p>": "", "<!-- all comment": "", "plain words only": "plain words only",
        "<article><p>un<i>closed<p>two<br>lines</article>after words": "unclosed\ntwo lines",
        "<main><p>1 < 2 and a<b>c</b></main>": "1 < 2 and ac",
        "<article><p>x</p><style>p{}</style><form>Your mail <input></form><p>y</p></article>": "x\ny",
        "<div class='content with-sidebar'><p>Main words stay.</p><div class='comment-body'>Reply</div></div>": "Main words stay.",
        "<article><div class='entry-header'><h1>Title</h1></div><p>x</p><div class='entry-footer'>Tags</div></article>": "Title\nx",
        "<div id=cookieNotice>We use cookies on this site</div><div><p>Real words of a page that go on for a while.</p></div>":
            "Real words of a page that go on for a while.",
    }
    assert {page: pages.main_text(page) for page in shown} == shown
    for page in pages.LABELLED:
        text = pages.main_text(page.replace("[[", "").replace("]]", ""))
        main = page[page.index("[[") + 2:page.index("]]")]
        assert text.split() == pages.main_text("<article>" + main + "</article>").split()


def test_pages_in_wrappers():
    words = "The old mill stands at the end of the lane and has not been used for years."
    body = f"<p>{words}</p><p>Children play there in summer.</p>"
    menu, side = "<nav><a href='/'>Home</a> <a href='/n'>News</a></nav>", "<div class='sidebar'><p>Popular posts</p></div>"
    main = words + "\nChildren play there in summer."
    for page in (
        f"<body><form method='post'>{menu}<div class='text'>{body}</div>{side}<footer>All rights reserved</footer></form></body>",
        f"<body>{menu}<div id='content-sidebar-wrap'><div>{body}</div>{side}</div><footer>The paper</footer></body>",
        f"<body class='x'>{menu}<div class='has-sidebar'><main>{body}</main>{side}</div></body>",
        f"<body><form><div class='post-with-comments'><article>{body}</article><section class='comments'><p>Nice mill</p></section></div></form>",
        f"<html><head><title>Mill</title><body><div class='header-fixed'><article>{body}</article></div></body></html>",
        f"<body><article>{body}</article><section class='comments'>" + "<article><p>Nice old mill, I was there too</p></article>" * 9 + "</section>",
        f"<body><div class='text'>{body}</div><aside><article><p>Related card</p></article></aside></body>",
        f"<body><div class='text'>{body}</div><div class='comments'>" + "<p>Nice old mill, I was there too</p>" * 9 + "</div></body>",
        f"<body><main></main><aside>{body}</aside></body>",
    ):
        assert pages.main_text(page) == main, page


def test_articles_of_links_are_whole():
    listed = "<h1>List</h1><ul>" + "".join(f"<li><a href='/{i}'>Item {i}</a></li>" for i in range(20)) + "</ul>"
    expected = "List\n" + "\n".join(f"Item {i}" for i in range(20))
    for page in (f"<article>{listed}</article>", f"<nav><a href='/'>Home</a></nav><main>{listed}</main><footer>The paper</footer>",
                 f"<div class='sidebar'>Popular</div><article>{listed}<div class='ad'>Buy</div></article><p>Imprint</p>"):
        assert pages.main_text(page) == expected
    assert pages.main_text("<article><h1>List</h1><ul><li><a>One</a></li><li><a>Two</a></li></ul></article>") == "List\nOne\nTwo"


def test_odd_markup_takes_linear_time():
    import time
    n = 100_000
    for page in ("<div>" * n + "</x>" * n, "<li><ul>" + "<i>" * n + "<li></li>" * n, "<svg>" * n + "<p>x", "<p>" * n, "<a href='" * n,
                 "</p>" * n + "<td>" * n, "<div><p>" * n + "</div>" * n, "<button>" * n):
        start = time.process_time()
        pages.main_text(page)
        assert time.process_time() - start < 20, page[:30]


def test_best_region_against_all_regions():
    rng = random.Random(9)
    kinds = [("tag", "p", "block"), ("tag", "b", ""), ("tag", "li", "gap"), ("text", "space", " "), ("text", "main", "one two"),
             ("text", "outside", "menu"), ("text", "plain-link", "a b c"), ("text", "plain", "words")]
    weights = {"<p": -0.5, "<b": -0.3, "<li": -2.0, "main": 1.5, "outside": -1.0, "plain": 0.4, "plain-link": -0.7}

    def total(events):
        score = 0.0
        for kind, name, value in events:
            if kind == "tag":
                score += weights["<" + name] * {"block": 1, "gap": 0}.get(value, 0.1)
            elif name != "space":
                score += weights[name] * len(value.split())
        return score

    for _ in range(300):
        found = [rng.choice(kinds) for _ in range(rng.randint(0, 14))]
        first, last = pages.best_region(found, weights)
        most = max((total(found[i:j]) for i in range(len(found)) for j in range(i, len(found) + 1)), default=0.0)
        assert total(found[first:last]) == pytest.approx(max(most, 0.0))


def test_pages_table(spark):
    df = spark.createDataFrame([(1, "u", "<p>a</p>", "t"), (None, None, None, "t"), (1, "u", "<p>a</p>", "t"), (2, "v", "<p>" * 50000, "t")],
                               "page_id long, url string, html string, text string")
    rows = sorted((r.page_id or 0, r.text, r.n_chars) for r in pages.extract(df).collect())
    assert rows == [(0, "", 0), (1, "a", 1), (1, "a", 1), (2, "", 0)]
    assert pages.extract(df.where("false")).collect() == []


def test_preferences(spark):
    schema = "conv_id long, turn long, role string, text string, prompt string"
    chosen = [(1, 0, "user", "q", "x"), (1, 1, "assistant", "good", "x"), (1, 2, "user", "more", "x"), (2, 0, None, None, "x"),
              (3, 0, "user", "same", "x"), (None, 0, "user", "none", "x"), (4, 0, "user", "alone", "x")]
    rejected = [(1, 0, "user", "q", "x"), (1, 1, "assistant", "bad one", "x"), (2, 0, "", "", "x"), (2, 1, "assistant", "a", "x"),
                (3, 0, "user", "same", "x"), (None, 0, "user", "none", "x")]
    found = {r.conv_id: r for r in chat.format_preferences(
        spark.createDataFrame(chosen, schema), spark.createDataFrame(rejected, schema)).collect()}
    assert set(found) == {1, 2, 3}
    one = found[1]
    assert (one.common_turns, one.prompt) == (1, "<|user|>\nq<|end|>\n")
    assert one.chosen[one.chosen_spans[0].start:one.chosen_spans[0].end] == "good<|end|>\n" and len(one.chosen_spans) == 1
    assert one.rejected[one.rejected_spans[0].start:one.rejected_spans[0].end] == "bad one<|end|>\n"
    assert found[3].chosen == found[3].rejected == "" and found[2].common_turns == 1 and found[2].rejected_spans[0].start == 14
    swapped = chat.with_foreign_reply(spark.createDataFrame(chosen + [(9, 0, "assistant", "other", "x")], schema)).collect()
    assert sorted((r.conv_id, r.common_turns) for r in swapped) == [(1, 1), (9, 0)]
    assert chat.with_foreign_reply(spark.createDataFrame([], schema)).collect() == []


def brute_kneser_ney(texts, order=quality.ORDER):
    """Probability of the last byte of a gram, from definitions, over byte tuples."""
    top = {}
    for text in texts:
        data = quality.BEGIN * (order - 1) + text.encode() + quality.END
        for i in range(len(data) - order + 1):
            top[data[i:i + order]] = top.get(data[i:i + order], 0) + 1
    counts = {order: top}
    for n in range(order - 1, 0, -1):
        counts[n] = {}
        for gram in counts[n + 1]:
            counts[n][gram[1:]] = counts[n].get(gram[1:], 0) + 1

    def chance(gram):
        if not gram:
            return 1 / quality.SYMBOLS
        n = len(gram)
        seen = [sum(c == i for c in counts[n].values()) for i in range(1, 5)]
        taken = quality.discounts(np.array(seen))
        follow = {g: c for g, c in counts[n].items() if g[:-1] == gram[:-1]}
        if not follow:
            return chance(gram[1:])
        total = sum(follow.values())
        left = sum(taken[min(c, 3)] for c in follow.values())
        own = follow.get(gram, 0)
        return ((own - taken[min(own, 3)]) if own else 0) / total + left / total * chance(gram[1:])
    return chance


def test_quality_model_against_definitions(spark, monkeypatch):
    monkeypatch.setattr(quality, "CHUNK", 100)
    rng = random.Random(4)
    rows = [(i, "".join(rng.choice("ab é") for _ in range(rng.randint(0, 40))), "x" if i % 2 else "y") for i in range(24)]
    rows += [(30, None, "x"), (31, "text of no model", "z"), (None, "ab", None), (32, "ab", "x"), (32, "ab", "x")]
    df = spark.createDataFrame([(*r, 1.0) for r in rows], "doc_id long, text string, lang string, nll double")
    trusted = [(i,) for i in range(0, 20)] + [(None,), (99,), (3,)]
    found = quality.scores(df, spark.createDataFrame(trusted, "doc_id long")).collect()
    models = {lang: brute_kneser_ney([t for i, t, l in rows if l == lang and i is not None and i < 20]) for lang in "xy"}
    got = sorted((r.doc_id or -1, r.n_bytes, round(r.nll, 4)) for r in found)
    expected = []
    for ident, text, lang in rows:
        data = quality.BEGIN * 4 + (text or "").encode() + quality.END
        chance = models.get(lang, lambda gram: 1 / quality.SYMBOLS)
        loss = -sum(np.log(chance(data[i:i + 5])) for i in range(len(data) - 4))
        expected.append((ident or -1, len(data) - 5, loss))
    for (a, n, x), (b, m, y) in zip(got, sorted(expected)):
        assert (a, n) == (b, m) and abs(x - y) < 1e-3 * max(1, y)


def test_quality_decisions(spark):
    rng = random.Random(8)
    good = lambda: " ".join(rng.choice(["the", "cat", "sat", "on", "mat", "and", "dog"]) for _ in range(80))
    rows = [(i, good(), "en") for i in range(200)] + [(i, "".join(rng.choice("#$%&@!XQZ") for _ in range(300)), "en") for i in range(200, 220)]
    rows += [(300, "", "en"), (301, None, "en"), (302, "anything", None)]
    docs = spark.createDataFrame([(*r, True) for r in rows], "doc_id long, text string, lang string, keep boolean")
    labels = spark.createDataFrame([(i, 1) for i in range(120)] + [(210, 0), (None, 1), (5, None)], "doc_id long, quality int")
    keep = {r.doc_id: r["kept"] for r in quality.judged(docs, labels).select("doc_id", F.col("keep").alias("kept")).collect()}
    assert len(keep) == len(rows)
    assert all(keep[i] for i in range(200)) and not any(keep[i] for i in range(200, 220))
    assert keep[300] and keep[301] and keep[302]
    assert quality.judged(docs.where("false"), labels.where("false")).collect() == []


def test_toxic_text_is_not_trusted(spark):
    labels = spark.createDataFrame([(1, 1, 0), (2, 1, 1), (3, 1, None), (4, 1, 0), (4, 1, 1), (5, 0, 0)], "doc_id long, quality int, toxic int")
    assert sorted(r.doc_id for r in quality.trusted_ids(labels).collect()) == [1, 3]


def test_languages_without_trusted_text_are_judged_by_all(spark):
    rng = random.Random(9)
    good = lambda: " ".join(rng.choice(["the", "cat", "sat", "on", "mat", "and", "dog"]) for _ in range(80))
    junk = lambda: "".join(rng.choice("#$%&@!XQZ") for _ in range(300))
    rows = [(i, good(), "en") for i in range(60)] + [(i, good(), None if i % 2 else "xx") for i in range(60, 80)]
    rows += [(i, junk(), (None, "xx", "en")[i % 3]) for i in range(80, 110)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    for trusted in (range(60), range(4)):  # of range(4), the hash may hold none out
        labels = spark.createDataFrame([(i, 1) for i in trusted], "doc_id long, quality int")
        found = {r.doc_id: r for r in quality.judged(docs, labels).withColumnRenamed("keep", "kept").collect()}
        assert {i: r.model for i, r in found.items()} == {i: lang or "" for i, _, lang in rows}
        assert {i for i, r in found.items() if r.kept} == set(range(80))


def test_what_an_operator_holds_goes_with_the_next_one():
    path = public_tokenizers.path("word_bpe_49k.json")
    own = packing.words_of(path)
    common.tidy(packing.words_of)
    assert packing.words_of(path) is own
    common.tidy()
    assert packing.words_of.cache_info().currsize == 0


def test_letters_are_encoded_by_the_model_alone_and_alike():
    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    texts = ["Plain words, and MORE words.", "Größe façade ÀÉÎ, ŉ ſtraße ª º Ǆ ǅ ȺȾ ß.", "İstanbul İ İ. café é.",
             "it's o'clock's 's end.. a.b x,y (z) 12a ١٢ слово слово. λόγος 漢字 🙂", "<|endoftext|> A<|endoftext|>b", " a b a​b", ""]
    own = packing.Words(path)
    for text, ids in zip(texts, own.encode(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids, text
    plain = packing.Words(path)
    plain.tokenizer = None  # the file's other steps are not asked
    ids, = plain.encode(["Plain words, and Größe."])
    assert np.frombuffer(ids, "<u4").tolist() == library.encode("Plain words, and Größe.", add_special_tokens=False).ids
    other = Tokenizer.from_file(path)
    other.normalizer = None
    assert packing.of_letters(other) is other


def test_parity_compares_lists_of_the_original_library():
    own = pieces.Backend(public_tokenizers.path("piece_bpe_32k.model"))
    library = own.library

    class Lists:
        def encode(self, units, **asked):
            assert asked.get("out_type") is int and "return_type" not in asked  # an array for each unit costs more than its encoding
            return [ids if unit != "odd" else ids + [1] for unit, ids in zip(units, library.encode(units, **asked))]

    own.library = Lists()
    found = own.encode(["some words ", "an odd word", " ", ""])
    assert [same for _, same in found] == [True, False, True, True]
    assert found[0][0].tolist() == library.encode("some words ") and found[1][0].tolist() == library.encode("an odd word")


def test_words_are_known_apart_from_their_last_marks():
    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    own, asked = packing.Words(path), []

    class File:
        def encode_batch_fast(self, texts, **how):
            asked.extend(texts)
            return library.encode_batch_fast(texts, **how)

    own.tokenizer = File()
    texts = ["thesblest*** la%%% la.%%% Größe,%%% é!! ", "la*** x_, y's. 12a. a<|endoftext|>", "<|endoftext|>.. <|x|>, a=b= é. É.\x1c.",
             " la. a̸. a.̸ ≮ 'S. it's' la.'s İ. ǅ. ª. ½, \v\f\r la", "", " . ", "́. .́"]
    for text, ids in zip(texts, own.encode(texts)):
        assert np.frombuffer(ids, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids, text
    assert {"***", "%%%", ".%%%"} <= set(asked) and not {"thesblest***", "la%%%", "la.%%%", "größe,%%%"} & {word.lower() for word in asked}


def test_known_words_are_held_in_little_memory():
    import tracemalloc

    import pyarrow as pa

    rng = random.Random(4)
    own = packing.Words(public_tokenizers.path("word_bpe_49k.json"))
    words = ["".join(rng.choices("aeinrst", k=9)) for _ in range(60000)]
    own.encode(["some first words"])
    tracemalloc.start()
    before = pa.total_allocated_bytes()
    for at in range(0, len(words), 5000):
        own.encode([" ".join(words[at:at + 5000])])
    held = pa.total_allocated_bytes() - before + tracemalloc.get_traced_memory()[0]
    tracemalloc.stop()
    assert held < 5 << 20  # some 240 bytes a word before
    small = packing.Words(public_tokenizers.path("word_bpe_49k.json"), most=1 << 18)
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    for at in [*range(0, 40000, 5000), 0]:  # more than it keeps, and met again
        text = " ".join(words[at:at + 5000])
        assert np.frombuffer(small.encode([text])[0], "<u4").tolist() == library.encode(text, add_special_tokens=False).ids
        assert small.known.nbytes + small.ids_of.nbytes + small.met.nbytes <= small.most


def test_runs_of_rows_are_whole_and_bounded():
    import pyarrow as pa

    texts = ["a" * n for n in (3, 0, 9, 2, 2, 2, 0, 5)]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], ["text"])
    found = [run.column("text").to_pylist() for run in packing.runs([batch, batch.slice(0, 0), batch.slice(2, 2)], "text", 5)]
    assert found == [texts[:2], texts[2:3], texts[3:5], texts[5:7], texts[7:], texts[2:3], texts[3:4]]


def test_shortened_texts_take_one_worker_a_task(spark):
    passage = "a passage of more than fifty bytes that two documents have alike, é at its end é"
    rows = [(1, passage), (2, "ü " + passage + " ü"), (3, None), (None, passage), (4, "short")]
    docs = spark.createDataFrame([(*row, 7) for row in rows], "doc_id long, text string, n_chars int")
    found = repeats.shortened(docs)
    assert "MapInArrow" not in found._jdf.queryExecution().toString()
    runs = {r.doc_id: r for r in repeats.spans(docs).collect()}
    assert {r.doc_id: (r.text, r.n_chars) for r in found.collect()} == {
        i: (shown := repeats.cut_text(r.text, r.removed), len(shown)) for i, r in runs.items()}
