"""Packing, page extraction, fingerprints, language identification and quality."""

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from noticelake.llm import fingerprints, langid, packing, pages, quality, simjoin

TABLE = "doc_id long, text string, lang string, source string, n_chars long"


def docs(spark, rows):
    return spark.createDataFrame([(i, t, lang, "s", 0) for i, t, lang in rows], TABLE).withColumns({"_range": F.lit(1), "score": F.lit("clash"), "keep": F.lit(2), "perplexity": F.lit("p"), "lang_pred": F.lit("l")})


# Packing


def test_word_encoder_equals_the_tokenizer():
    from tokenizers import Tokenizer

    whole, fast = Tokenizer.from_file(packing.default_tokenizer()), packing.WordEncoder(packing.default_tokenizer(), most=20)
    rng = random.Random(1)
    pool = list("abcXYZéÜßñ'.,!&%0123 \n\t\r\x1c\u00a0日本ﬁİΣς_`<|>")
    texts = ["".join(rng.choice(pool) for _ in range(rng.randrange(60))) for _ in range(400)] + ["it's don't we've <|endoftext|> THE END", ""]
    for t in texts:
        assert fast.encode(t).tolist() == whole.encode(t, add_special_tokens=False).ids, t


class Counted:
    """A tokenizer's model that notes what it is asked."""

    def __init__(self, model):
        self.model, self.asked = model, []

    def tokenize(self, piece):
        self.asked.append(piece)
        return self.model.tokenize(piece)


def test_a_word_goes_to_the_model_once_for_all_its_spellings():
    enc = packing.WordEncoder(packing.default_tokenizer())
    want = [enc.whole.encode(t, add_special_tokens=False).ids for t in ("Noticelake noticelake, NOTICELAKE!", "noticelake! Noticelake")]
    enc.model = Counted(enc.model)
    assert [enc.encode(t).tolist() for t in ("Noticelake noticelake, NOTICELAKE!", "noticelake! Noticelake")] == want
    assert sorted(enc.model.asked) == ["!", ",", "noticelake"]


def test_words_met_last_stay_known():
    enc = packing.WordEncoder(packing.default_tokenizer(), most=20)
    enc.model = Counted(enc.model)
    for i in range(40):  # a new word each time beside one that always comes back
        enc.encode("always " + "".join(chr(97 + int(d)) for d in str(1000 + i)))
    assert enc.model.asked.count("always") == 1 and len(enc.known) <= 21


def test_lots_of_texts_have_the_ids_of_each():
    import pyarrow as pa

    rng = random.Random(3)
    texts = [" ".join(rng.choice(["Wort", "für", "it's", "x1,", "(und)", "", "\t", "日本", "Ende."]) for _ in range(rng.choice([0, 1, 30, 400, 900]))) for _ in range(90)]
    enc = packing.WordEncoder(packing.default_tokenizer(), most=5)
    batches = [pa.record_batch([pa.array(range(len(t)), pa.int64()), pa.array(t, kind)], ["doc_id", "text"]) for t, kind in ((texts, pa.string()), ([], pa.string()), (texts[::-1], pa.large_string()))]
    got = list(packing._encoded(enc, [batches[0].slice(1), *batches[1:]], lot=3000))
    assert [i for i, _ in got] == [*range(1, 90), *range(90)]
    for (_, ids), t in zip(got, texts[1:] + texts[::-1], strict=True):
        assert ids.tolist() == enc.whole.encode(t, add_special_tokens=False).ids


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(1, 9000), max_size=60), st.sampled_from([64, 5000, 1 << 20]))
def test_packer_keeps_every_id_and_pads_one_window(sizes, hold):
    p = packing.Packer(hold=hold)
    for i, n in enumerate(sizes):
        p.add(i, n)
    p.pack()
    covered = {i: [] for i in range(len(sizes))}
    padded = 0
    for context, window in p.full:
        total = sum(n for _, _, n in window)
        assert context in packing.TIERS and total <= context
        padded += total < context
        for doc, start, n in window:
            covered[doc].append((start, n))
    assert padded <= 1
    for i, n in enumerate(sizes):
        at = 0
        for start, length in sorted(covered[i]):
            assert start == at and length > 0
            at += length
        assert at == n


def test_pieces(spark):
    from tokenizers import Tokenizer

    rng = random.Random(2)
    rows = [(i, " ".join(rng.choice(["alpha", "beta,", "gamma"]) for _ in range(rng.choice([0, 3, 50, 900, 6000]))), "en") for i in range(60)] + [(None, None, None), (3, "alpha", "en"), (3, "alpha", "en")]
    got = packing.pack_documents(docs(spark, rows)).toPandas()
    whole = Tokenizer.from_file(packing.default_tokenizer())
    ids = {t: np.array([*whole.encode(t or "", add_special_tokens=False).ids, 1], "<u4") for _, t, _ in rows}
    assert got["length"].sum() == sum(len(ids[t]) for _, t, _ in rows)
    known = {(i, zlib.crc32(ids[t][s : s + n])) for i, t, _ in rows for s, n in [(0, len(ids[t]))]}
    single = got[(got["start"] == 0) & (got["length"] == got["doc_tokens"])]
    assert all((None if r.doc_id != r.doc_id else int(r.doc_id), r.ids_crc32) in known for r in single.itertuples())
    for r in got.itertuples():
        texts = [t for i, t, _ in rows if (i is None) == (r.doc_id != r.doc_id) and (i is None or i == r.doc_id)]
        assert any(zlib.crc32(ids[t][r.start : r.start + r.length]) == r.ids_crc32 and len(ids[t]) == r.doc_tokens for t in texts)
    sequences = got.sort_values(["sequence_id", "offset"]).groupby("sequence_id")
    assert ((sequences["length"].cumsum() - got.sort_values(["sequence_id", "offset"])["length"]) == got.sort_values(["sequence_id", "offset"])["offset"]).all()
    assert sequences["length"].sum().max() <= 2048
    assert packing.pack_documents(docs(spark, rows).limit(0)).count() == 0


def test_contexts_and_step_groups(spark):
    rng = random.Random(7)
    rows = [(i, " ".join(["alpha"] * rng.randrange(1, 4000)), "en") for i in range(80)]
    got = packing.pack_documents(docs(spark, rows).coalesce(1)).toPandas()
    windows = got.groupby(["context", "step_group", "sequence_id"])["length"].sum().reset_index()
    assert set(windows["context"]) <= set(packing.TIERS) and (windows["length"] <= windows["context"]).all()
    assert (windows["length"] < windows["context"]).sum() <= 1
    groups = windows.groupby(["context", "step_group"]).size().reset_index(name="n")
    assert groups["step_group"].is_unique
    full = groups["n"] * groups["context"] == 1 << 16
    assert (~full).groupby(groups["context"]).sum().max() <= 1  # of each context the last group is open


def test_long_texts_come_out_as_they_are():
    long = "Wort für Wort, " * 150_000
    enc = packing.encoder(packing.default_tokenizer())
    assert (enc.encode(long) == np.concatenate([enc._encode("Wort für Wort,")] * 150_000)).all()
    exact = sum(len(k) for k, _ in langid.grams([long]))
    assert sum(len(k) for lot in langid._windows([long]) for k, _ in langid.grams(lot)) == exact
    rng = random.Random(1)
    words = [f"w{rng.randrange(50)}" for _ in range(400_000)]
    assert len(simjoin.shingles([" ".join(words)])[0]) == len({tuple(words[i : i + 5]) for i in range(len(words) - 4)})
    marked = quality.START * (quality.ORDER - 1) + long + quality.END
    assert sum(len(at) for _, at, _ in quality._windows([long])) == len(marked) - quality.ORDER + 1


# Pages

PAGE = """<!DOCTYPE html><html><head><title>t</title><script>var a="<p>no</p>";</script></head><body><nav><ul><li><a href="/">Home</a></li></ul></nav>
<div class="ad">Buy &amp; save</div><article><h1>Head  line</h1><p>One <b>bold</b>&nbsp;&amp;lt; two<br>three<div class="sidebar">side</div><p>Last<aside>x</aside> words</article>
<div id="comments"><p>nice article really nice</div><footer>&copy; me</footer></body></html>"""


def test_page_text(spark):
    rows = [(i, f"u{i}", PAGE) for i in range(20)] + [(30, "u", None), (31, None, ""), (None, "v", "plain words &amp; more"), (33, "w", PAGE.replace("</body></html>", "")), (34, "x", "<article><p>cut &am")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({"text": F.lit("clash"), "n_chars": F.lit("x")})
    got = {r["page_id"]: r for r in pages.extract_pages(df).collect()}
    assert got[0]["text"] == "Head line\nOne bold &lt; two\nthree\nLast\nwords" and got[33]["text"] == got[0]["text"]
    assert got[0]["n_chars"] == len(got[0]["text"])
    assert got[30]["text"] == "" and got[31]["text"] == "" and got[None]["text"] == "plain words & more" and got[34]["text"] == "cut &am"
    assert pages.extract_pages(df.limit(0)).count() == 0


def test_best_run_against_brute_force():
    rng = random.Random(3)
    for _ in range(200):
        scores = [rng.choice([-3, -1, -0.5, 0, 1, 2]) for _ in range(rng.randrange(25))]
        start, stop = pages.best_run(scores)
        want = max([sum(scores[i:j]) for i in range(len(scores)) for j in range(i + 1, len(scores) + 1)] + [0])
        assert sum(scores[start:stop]) == pytest.approx(want)


def _page(rng, box="article", odd="zqx"):
    words = lambda n: " ".join(rng.choice(["alpha", "beta", "gamma", "delta"]) for _ in range(n))
    paragraphs = [words(rng.randrange(4, 40)) for _ in range(rng.randrange(1, 6))]
    menu = "".join(f"<li><a href=x>{words(1)}</a></li>" for _ in range(8))
    inside = f"<div class='{odd}'>{words(25)}</div>"
    body = f"<h1>{words(5)}</h1>" + "".join(f"<p>{p}</p>" for p in paragraphs)
    head, _, tail = body.rpartition("<p>")
    start, end = (f"<{box}>", f"</{box.split()[0]}>") if box else ("", "")
    html = f"<html><body><nav><ul>{menu}</ul></nav><div class={odd}>{words(30)}</div>{start}{head}{inside}<p>{tail}{end}<section id=part9>{words(40)}</section><footer>{words(9)}</footer></body></html>"
    return html, "\n".join(x for x in pages.re.sub("<[^>]*>", "\n", f"{head}<p>{tail}").split("\n") if x)


def test_weights_are_learned_and_decide(spark):
    rng = random.Random(5)
    labelled = [_page(rng) for _ in range(150)]
    weights = pages.learn(spark.createDataFrame([(i, h) for i, (h, _) in enumerate(labelled)], "page_id long, html string"))
    assert weights.words[".zqx"] < 0.5 < weights.words["p"] and weights.tags["nav"] == pages.LEAST and weights.tags["p"] > -0.1
    for box in ("article", "main class=story", "div id=k", ""):
        hidden = [_page(rng, box) for _ in range(60)]
        got = [(pages.extract(h, weights), want) for h, want in hidden]
        both = [(set(enumerate(g.split())), set(enumerate(w.split()))) for g, w in got]
        assert np.mean([g == w for g, w in got]) >= 0.95, box
        assert sum(len(a & b) for a, b in both) >= 0.97 * max(sum(len(a) for a, _ in both), sum(len(b) for _, b in both))
    # without what the pages teach, the unnamed boxes stay
    page, want = _page(rng)
    assert pages.extract(page, weights) == want != pages.extract(page, pages.Weights())
    # boilerplate by name that the pages show to be the article
    odd = spark.createDataFrame([(i, f"<body><article><p class=comment>{'word ' * 30}</p></article><p>x</p></body>") for i in range(60)], "page_id long, html string")
    assert pages.extract("<body><p class=comment>a b c d</p><nav>x</nav></body>", pages.learn(odd)) == "a b c d"


def test_menus_without_names_end_the_region():
    menu = "<ul>" + "<li><a href=x>Home</a></li>" * 20 + "</ul>"
    assert pages.extract(f"<body><div>{menu}</div><div><p>{'word ' * 60}</p></div><div>{menu}</div></body>", pages.Weights()) == " ".join(["word"] * 60)


def test_hostile_pages_end():
    weights = pages.Weights()
    assert pages.extract("<" * 20000, weights).startswith("<")
    for page in ("<b></i>" * 40000, "<b>" * 40000 + "</i>" * 40000 + "x", "<a href='" * 2000, "<div class=ad>" * 30000 + "x"):
        pages.extract(page, weights)
    assert len(pages.extract("<p>" + "word " * 2_000_000, weights)) == 9_999_999


# Fingerprints


def test_pictures_and_templates_take_no_text_away():
    """What closes itself, never ends or ends elsewhere keeps nothing that follows; what it holds is left out."""
    a, b = " ".join(["eins"] * 60), " ".join(["zwei"] * 60)
    page = "<body><nav><a>menu</a></nav><article><p>{0}</p>{1}<p>{2}</p></article><footer>foot</footer></body>"
    want = pages.extract(page.format(a, "", b), pages.Weights())
    assert want == a + "\n" + b
    icons = ["<{0}/>", "<{0} class='i'/>", "<{0}>", "<{0} a=1>", "<{0}>x x</{0}>", "<{0} b='>'>x</{0}>", "<{0}/>" * 50]
    for tag in ("svg", "math", "template", "noscript", "iframe", "script", "style", "textarea", "title"):
        for icon in icons:
            assert pages.extract(page.format(a, icon.format(tag), b), pages.Weights()) == want, (tag, icon)
            assert pages.extract(page.format(a, "<p>" + icon.format(tag) + "</p>", b), pages.Weights()) == want, (tag, icon)
    for misnested in ("<p><svg></p>", "<p><svg><path d='1'></p>", "<svg><p>" + "drei " * 9 + "</p></svg>", "<p><noscript></p>", "</svg></template>"):
        text = pages.extract(page.format(a, misnested, b) + "<svg></svg><noscript></noscript>", pages.Weights())
        assert text.startswith(a) and text.endswith(b), misnested
    inline = pages.extract(f"<article><p>{a} x<svg><path/>y</svg>z {b}</p></article>", pages.Weights())
    assert inline == f"{a} xz {b}"
    for hostile in ("<svg>" * 100_000, "<script>" * 100_000, "<svg><p>" * 50_000 + "</svg>", "<iframe/>" * 100_000 + "</iframe>"):
        pages.extract(hostile, pages.Weights())


def test_rolling_hash_depends_on_seven_bytes_only():
    rng = np.random.default_rng(1)
    a, b = rng.integers(0, 256, 500, np.uint8), rng.integers(0, 256, 500, np.uint8)
    b[200:] = a[200:]
    x, y = (fingerprints._rolling(v.astype(np.uint32)) for v in (a, b))
    assert (x[206:] == y[206:]).all() and (x[:200] != y[:200]).any()


def _lcs(x, y):
    row = [0] * (len(y) + 1)
    for c in x:
        last = 0
        for j, d in enumerate(y, 1):
            last, row[j] = row[j], last + 1 if c == d else max(row[j], row[j - 1])
    return row[-1]


def _by_hand(data):
    """The fingerprint in plain loops."""
    n, sizes = len(data), []
    if not n:
        return "3::"
    block = 3
    while block * 64 < n:
        block *= 2
    piece = 4 * block
    rolled = []
    for i in range(n):
        window = [(k, data[i - k]) for k in range(min(7, i + 1))]
        mixed = 0
        for k, b in window:
            mixed ^= (b << 5 * k) & 0xFFFFFFFF
        rolled.append((sum(b * (8 - k) for k, b in window) + mixed) & 0xFFFFFFFF)

    def chunks(size, piece):
        out, start = [], 0
        for i in range(n):
            if rolled[i] % size == size - 1 or i == n - 1:
                while i + 1 - start > piece:
                    out.append((start, start + piece))
                    start += piece
                out.append((start, i + 1))
                start = i + 1
        return out

    while len(chunks(block, piece)) > 64:
        block *= 2
    while block > 3 and len(chunks(block, piece)) < 32 and len(chunks(block // 2, piece)) <= 64:
        block //= 2
    for size, long in ((block, piece), (2 * block, 2 * piece)):
        text = ""
        for a, b in chunks(size, long):
            h = sum((data[i] + 1) * pow(0x9E3779B97F4A7C15, i - a, 1 << 64) for i in range(a, b)) % (1 << 64)
            h ^= h >> 29
            text += "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"[(h * 0xBF58476D1CE4E5B9 % (1 << 64)) >> 58]
        sizes.append(text)
    return f"{block}:{sizes[0]}:{sizes[1]}"


def test_fingerprint_against_plain_loops(monkeypatch):
    rng = random.Random(2)
    texts = [b"", b"a", b"ab" * 40, b"x" * 900, *(bytes(rng.choice(b"abc de\n") for _ in range(n)) for n in (5, 63, 400, 1500)), "é日本 ".encode() * 90]
    for t in texts:
        assert fingerprints.fingerprint(t) == _by_hand(t)
    monkeypatch.setattr(fingerprints, "BLOCK", 50)  # many blocks
    monkeypatch.setattr(fingerprints, "_POWERS", [])
    for t in texts:
        assert fingerprints.fingerprint(t) == _by_hand(t)


def test_a_doc_id_of_most_rows(spark):
    rng = random.Random(9)
    text = lambda: "".join(rng.choice("abcdef ") for _ in range(60))
    rows = [(5, text(), "en") for _ in range(300)] + [(i, text(), "en") for i in range(40)]
    got = fingerprints.fingerprint_documents(docs(spark, rows))
    assert got.rdd.glom().map(len).max() < 300 and got.count() == len(rows)
    shas = Counter(r["edited_sha256"] for r in got.collect())
    before = Counter(hashlib.sha256((t[:30] + n[:30]).encode()).hexdigest() for t, n in [(a, b) for _, a, _ in rows for _, b, _ in rows])
    assert len(shas) == len(rows) and not shas - before


def test_likeness_is_edit_distance():
    rng = random.Random(4)
    pairs = []
    for _ in range(60):
        x = "".join(rng.choice("ABCDEFGH") for _ in range(rng.randrange(1, 65)))
        y = x[: rng.randrange(len(x) + 1)] + "".join(rng.choice("ABCDEFGH") for _ in range(rng.randrange(20)))
        pairs.append((x, y[:64]))
    for (x, y), got in zip(pairs, fingerprints._similar(pairs), strict=True):
        want = 2 * _lcs(x, y) / (len(x) + len(y)) if x and y and fingerprints._common(x, y) else 0
        assert got == pytest.approx(want)


def test_fingerprints_of_neighbours(spark):
    rng = random.Random(6)
    text = lambda n: "".join(rng.choice("abcdefgé \n") for _ in range(n))
    rows = [(i * 3, text(rng.choice([0, 1, 7, 200, 3000])), "en") for i in range(120)] + [(9, "twin", "en"), (9, "twin", "en"), (None, "first", None), (12, None, "en"), (500, text(150_000), "en")]
    got = fingerprints.fingerprint_documents(docs(spark, rows)).collect()
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, (r[1] or "").encode()))
    want = []
    for (i, t, _), (_, n, _) in zip(order, [*order[1:], order[0]], strict=True):
        t, n = t or "", n or ""
        e = t[: len(t) - len(t) // 2] + n[: len(t) // 2]
        want.append((i, len(t), hashlib.sha256(e.encode()).hexdigest(), fingerprints.fingerprint(t.encode()), fingerprints.fingerprint(e.encode())))
    key = lambda r: (r[0] is not None, r[0] or 0, r[1:])
    assert sorted([tuple(r)[:5] for r in got], key=key) == sorted(want, key=key)
    assert all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in got)
    assert np.mean([r["near_edited"] for r in got if r["n_chars"] >= 3000]) > 0.45
    assert np.mean([r["near_next"] for r in got if r["n_chars"] >= 3000]) < 0.15
    assert fingerprints.fingerprint_documents(docs(spark, rows).limit(0)).count() == 0
    only = fingerprints.fingerprint_documents(docs(spark, [(1, "abcd", "en")])).first()
    assert only["edited_sha256"] == hashlib.sha256(b"abab").hexdigest() and only["near_next"] == 1


def test_signature_spans_repeated_texts():
    rng = random.Random(16)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randrange(2, 8)))
    near = []
    for _ in range(60):
        lines = [(word() + " ") * 60 for _ in range(12)]
        whole = "".join(lines)
        other = "".join(word() + " " for _ in range(len(whole)))[: len(whole) // 2]
        block, x, y = fingerprints.fingerprint(whole.encode()).split(":")
        assert 8 <= len(x) <= 64 and 1 <= len(y) <= 64 and int(block) >= 3
        tail = fingerprints.fingerprint((whole[:-300] + "".join(word() + " " for _ in range(300))[:300]).encode())
        assert tail.split(":", 1)[1] != f"{x}:{y}"
        near.append(fingerprints.likeness([(f"{block}:{x}:{y}", fingerprints.fingerprint((whole[: len(whole) - len(other)] + other).encode()))])[0])
    assert max(near) < 0.9


# Languages

WORDS = {"xa": "the of and ing tion er", "yb": "der die und ung sch keit", "zc": "que les des eau oi ment"}


def prose(rng, lang, n):
    return " ".join("".join(rng.choice(WORDS[lang].split()) for _ in range(rng.randrange(1, 4))) for _ in range(n))


def test_languages(spark):
    rng = random.Random(8)
    rows = [(i, prose(rng, lang, rng.randrange(5, 80)), lang) for i, lang in enumerate(rng.choice(list(WORDS)) for _ in range(400))]
    rows += [(900, None, "xa"), (901, "123 !?", "xa"), (902, prose(rng, "zc", 30), None), (None, "THE OF", "xa"), (903, "", None)]
    got = langid.language_documents(docs(spark, rows)).toPandas()
    assert len(got) == len(rows) and got["score"].between(0, 1).all()
    by = {int(r.doc_id): r for r in got.itertuples() if r.doc_id == r.doc_id}
    assert all(by[i].held_out == (zlib.crc32(str(i).encode()) % 5 == 0) for i in by)
    held = [by[i].lang_pred == lang for i, _, lang in rows[:400] if by[i].held_out]
    assert np.mean(held) > 0.95
    assert by[900].lang_pred == by[901].lang_pred == by[903].lang_pred == "und" and by[902].lang_pred == "zc"
    kept = langid.keep_identified(docs(spark, rows))
    assert kept.columns == docs(spark, rows).columns and 380 <= kept.count() <= 402
    assert langid.language_documents(docs(spark, rows).limit(0)).count() == 0
    assert {r["lang_pred"] for r in langid.language_documents(docs(spark, [(1, "abc", None)])).collect()} == {"und"}


def test_gibberish_and_mixed_texts_are_rejected(spark):
    rng = random.Random(12)
    rows = [(i, prose(rng, lang, rng.randrange(20, 80)), lang) for i, lang in enumerate(rng.choice(list(WORDS)) for _ in range(600))]
    letters = lambda: " ".join("".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randrange(2, 9))) for _ in range(60))
    junk = [(1000 + i, letters(), rng.choice(list(WORDS))) for i in range(30)]
    copied = [(1100 + i, junk[0][1], "xa") for i in range(10)]
    mixed = [(1200 + i, prose(rng, "xa", 40) + " " + prose(rng, "zc", 40), rng.choice(["xa", "zc"])) for i in range(30)]
    kept = {r["doc_id"] for r in langid.keep_identified(docs(spark, rows + junk + copied + mixed)).collect()}
    assert not kept & {i for i, _, _ in junk + copied + mixed}
    assert len(kept) >= 0.98 * len(rows)


def test_shares_against_sets(spark):
    rng = random.Random(21)
    rows = [(i, prose(rng, lang, rng.randrange(1, 30)), lang) for i, lang in enumerate(rng.choice(list(WORDS)) for _ in range(150))]
    filters = langid.learn(docs(spark, rows))
    assert filters.masks.shape[1] == 1 << 16 and filters.languages == sorted(WORDS)

    def named(text):
        out = Counter()
        for word in "".join(c if c.isalpha() else " " for c in text.lower()).split():
            word = f" {word} "
            out.update((n, word[i : i + n]) for n in langid.ORDERS for i in range(len(word) - n + 1))
        return out

    held = {lang: Counter() for lang in filters.languages}
    for _, t, lang in rows:
        held[lang].update(named(t))
    share = {g: {lang: c[g] / sum(c.values()) for lang, c in held.items() if g in c} for g in set().union(*held.values())}
    known = {lang: {g for g, s in share.items() if s.get(lang, 0) >= 0.2 * max(s.values()) and lang in s} for lang in held}
    texts = [prose(rng, lang, 25) for lang in WORDS for _ in range(10)] + ["", "12", "zzz qqq"]
    total, shares = filters.shares(texts)
    for t, n, got in zip(texts, total, shares, strict=True):
        want = named(t)
        assert n == sum(want.values())
        for lang, x in zip(filters.languages, got, strict=True):
            assert abs(x - sum(c for g, c in want.items() if g in known[lang]) / max(sum(want.values()), 1)) < 0.03


def test_filter_size_follows_the_data():
    assert langid.filter_size(1000) == 1 << 16 and langid.filter_size(200_000) == 1 << 22
    assert langid.filter_size(3_000_000) == langid.filter_size(50_000_000) == langid.MOST_SLOTS
    # 5.8 million n-grams of a language fit; of twenty million those that occur four times or more
    assert langid.least_count({"a": {0: 5_800_000}, "b": {}}) == 1
    assert langid.least_count({"a": {0: 12_000_000, 1: 5_000_000, 2: 2_500_000, 5: 500_000}, "b": {0: 9}}) == 4
    assert langid.least_count({}) == 1


def test_filters_hold_the_frequent_grams_of_large_vocabularies(spark):
    """A filter far too small for all n-grams still tells languages apart by those that are frequent."""
    r = random.Random(8)
    rows = []
    for i in range(400):
        lang = ("a", "b")[i % 2]
        common = r.choices(["haus", "baum", "wind"] if lang == "a" else ["casa", "arbol", "viento"], k=20)
        rare = ["".join(r.choices("abcdefghijklmnopqrstuvwxyz", k=8)) for _ in range(60)]
        rows.append((" ".join(common + rare), lang))
    df = spark.createDataFrame(rows, "text string, lang string").withColumn("fold", F.lit(0))
    small = langid._filters(langid._counted(df), None, 0.2, most=1 << 16)
    assert small.masks.shape == (1, 1 << 16) and (small.false_positives() <= langid.TOO_FALSE).all()
    total, shares = small.shares(["haus baum wind haus", "casa viento arbol"])
    assert shares.argmax(axis=1).tolist() == [0, 1] and (total > 0).all()
    whole = langid._filters(langid._counted(df), None, 0.2)
    assert whole.masks.shape[1] > 1 << 16


def test_filter_shares_are_corrected():
    keys = np.random.default_rng(1).integers(1, 2**63, 3000, np.uint64)
    masks = np.zeros((2, 4096), np.uint64)
    for at in langid.slots(keys[:1000], 4096):
        masks[1, at] |= np.uint64(1)  # the 64th language
    f = langid.Filters([f"l{i:02}" for i in range(64)], masks)
    assert f.false_positives()[63] == pytest.approx((np.count_nonzero(masks[1]) / 4096) ** 2)
    hit = [(masks[1, a] & masks[1, b] & np.uint64(1)).astype(bool) for a, b in [langid.slots(keys, 4096)]][0]
    assert hit[:1000].all()
    fp = f.false_positives()[63]
    assert abs((hit[1000:].mean() - fp) / (1 - fp)) < 0.05


# Quality


def _model(texts, order):
    """Interpolated modified Kneser-Ney, from counts in dictionaries."""
    from collections import Counter, defaultdict

    mark = [quality.START * (order - 1) + t + quality.END for t in texts]
    counts = {order: Counter(m[i : i + order] for m in mark for i in range(len(m) - order + 1))}
    for k in range(order - 1, 0, -1):
        counts[k] = Counter(g[1:] for g in counts[k + 1])
    ds, ctx = {}, {}
    for k in range(1, order + 1):
        n = Counter(counts[k].values())
        ds[k] = [0.0, *quality._discounts(n[1], n[2], n[3], n[4])]
        ctx[k] = defaultdict(list)
        for g, c in counts[k].items():
            ctx[k][g[:-1]].append(c)

    def p(g):
        k = len(g)
        if k == 0:
            return 1 / (len(counts[1]) + 1)
        seen = ctx[k].get(g[:-1])
        if not seen:
            return p(g[1:])
        c = counts[k].get(g, 0)
        return (c - ds[k][min(c, 3)]) / sum(seen) + sum(ds[k][min(x, 3)] for x in seen) / sum(seen) * p(g[1:])

    return p


def test_probabilities_against_dictionaries(spark):
    rng = random.Random(9)
    good = [prose(rng, "xa", rng.randrange(1, 30)) for _ in range(60)]
    other = [prose(rng, "yb", 12), "", "日本"]
    df = spark.createDataFrame([(t, True) for t in good] + [(t, False) for t in other], "text string, trusted boolean")
    got = {r["gram"]: r["logp"] for r in quality.probabilities(quality._asked(df, 3)).collect()}
    p = _model(good, quality.ORDER)
    grams = {m[i : i + quality.ORDER] for t in good + other for m in [quality.START * (quality.ORDER - 1) + t + quality.END] for i in range(len(m) - quality.ORDER + 1)}
    assert set(got) == grams
    for g in grams:
        assert got[g] == pytest.approx(np.log(p(g)), rel=1e-9), repr(g)
    total = sum(p("theo"[:4] + c) for c in {*"".join(good), quality.END}) + p("theo" + "\u9999")
    assert total <= 1 + 1e-9


def test_classifier_in_runs_of_any_size(spark):
    rng = random.Random(10)
    rows = [(i, prose(rng, "xa" if i % 2 else "yb", rng.randrange(10, 60)), "xa" if i % 2 else "yb") for i in range(500)]
    junk = [(1000 + i, "".join(rng.choice("#$%&*") for _ in range(200)), "xa") for i in range(20)]
    odd = [(2000, None, "xa"), (2001, "", None), (None, prose(rng, "xa", 20), "xa"), (3, rows[3][1], "yb"), (2002, prose(rng, "zc", 3), "new")]
    df = docs(spark, rows + junk + odd)
    labels = spark.createDataFrame([(i, 1, 0) for i in range(400)] + [(1000, 0, 0), (None, 1, 0), (5, 1, 1)], "doc_id long, quality int, toxic int")
    got = quality.quality_documents(df, labels).collect()
    assert len(got) == len(rows + junk + odd)
    kept = {r["doc_id"]: r["keep"] for r in got}
    assert np.mean([kept[i] for i, _, _ in rows]) > 0.97 and not any(kept[i] for i, _, _ in junk)
    shuffled = {(r["doc_id"], r["lang"]): r["perplexity"] for r in quality.classify(df.select("doc_id", "text", "lang"), labels, size=500).collect()}
    for r in got:
        assert shuffled[r["doc_id"], r["lang"]] == pytest.approx(r["perplexity"], rel=1e-5)
    good = quality.keep_good(df, labels)
    assert good.columns == df.columns and good.count() == sum(r["keep"] for r in got)
    assert quality.quality_documents(df.limit(0), labels).count() == 0
    assert all(r["keep"] for r in quality.quality_documents(df.limit(20), labels.limit(0)).collect())


def test_toxic_documents_are_not_trusted(spark):
    rng = random.Random(13)
    clean = [(i, prose(rng, "xa", rng.randrange(20, 60)), "xa") for i in range(400)]
    toxic = [(1000 + i, prose(rng, "zc", rng.randrange(20, 60)), "xa") for i in range(60)]
    labels = spark.createDataFrame([(i, 1, 0) for i, _, _ in clean] + [(i, 1, 1) for i, _, _ in toxic] + [(7, 1, 1), (8, 0, 0), (9, 1, None)], "doc_id long, quality int, toxic int")
    assert {r["doc_id"] for r in quality.trusted_ids(labels).collect()} == set(range(400)) - {7, 8, 9}
    kept = {r["doc_id"]: r["keep"] for r in quality.quality_documents(docs(spark, clean + toxic), labels).collect()}
    assert not any(kept[i] for i, _, _ in toxic) and np.mean([kept[i] for i, _, _ in clean]) > 0.97


def test_threshold_is_the_quantile_itself(spark):
    rng = random.Random(14)
    clean = [(i, prose(rng, "xa", rng.randrange(40, 80)), "xa") for i in range(600)]
    weak = [(1000 + i, " ".join(["".join(rng.choice(WORDS["xa"].split()) for _ in range(3))] * 60), "xa") for i in range(60)]
    few = [(2000 + i, prose(rng, "yb", rng.randrange(40, 80)), "yb") for i in range(20)]
    labels = [(i, 1, 0) for i, _, _ in clean + few] + [(i, 0, 0) for i, _, _ in weak]
    rows = quality.quality_documents(docs(spark, clean + weak + few), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
    apart = {r[0] for r in spark.range(600).where(F.pmod(F.xxhash64(F.lit("quality"), F.col("id")), F.lit(5)) == 0).collect()}
    held = sorted(r["perplexity"] for r in rows if r["doc_id"] in apart)
    limits = {r["lang"]: r["threshold"] for r in rows}
    assert limits["xa"] == pytest.approx(held[int(np.ceil(0.99 * len(held))) - 1])
    kept = {r["doc_id"]: r["keep"] for r in rows}
    assert np.mean([kept[i] for i, _, _ in clean]) > 0.98
    assert np.mean([kept[i] for i, _, _ in weak]) < 0.6  # one word over and over
    assert 0 < np.log(limits["yb"]) < np.log(limits["xa"]) + 0.1


def test_no_model_passes_through_the_driver(spark, monkeypatch):
    rng = random.Random(15)
    rows = [(i, prose(rng, "xa", rng.randrange(1, 40)), "xa") for i in range(80)] + [(90, "a" * 3000, "xa"), (91, "a" * 3000, "yb"), (92, None, "xa")]
    df = docs(spark, rows).select("doc_id", "text", "lang")
    logp = quality.probabilities(quality._asked(df.select("text", (F.col("doc_id") < 60).alias("trusted")), 3))
    logs = {r["gram"]: r["logp"] for r in logp.collect()}

    def no(*_):
        raise AssertionError("a table came to the driver")

    monkeypatch.setattr(type(df), "toArrow", no)
    monkeypatch.setattr(type(spark.sparkContext), "broadcast", no)
    got = {r["doc_id"]: r for r in quality.with_scores(df, logp, "nll", "chars", size=700).collect()}
    assert len(got) == len(rows)
    for i, t, _ in rows:
        m = quality.START * (quality.ORDER - 1) + (t or "") + quality.END
        assert got[i]["chars"] == len(t or "") + 1
        assert got[i]["nll"] == pytest.approx(-sum(logs[m[j : j + quality.ORDER]] for j in range(len(m) - quality.ORDER + 1)), rel=1e-5)


# Shared helpers


def test_checkpoints_need_a_shared_folder_on_a_cluster(spark, monkeypatch):
    from types import SimpleNamespace

    from noticelake.llm import common

    undefined = SimpleNamespace(sc=lambda: SimpleNamespace(getCheckpointDir=lambda: SimpleNamespace(isDefined=lambda: False)))
    chosen = []
    context = lambda master: SimpleNamespace(_jsc=undefined, master=master, getConf=lambda: {}, setCheckpointDir=chosen.append)
    frame = lambda master, folder=None: SimpleNamespace(sparkSession=SimpleNamespace(sparkContext=context(master), conf=SimpleNamespace(get=lambda *_: folder)), checkpoint=lambda eager: "written")
    for master in ("spark://host:7077", "yarn", "local-cluster[2,1,1024]"):
        with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
            common.checkpoint(frame(master))
    assert common.checkpoint(frame("yarn", "hdfs:///shared")) == "written" and chosen == ["hdfs:///shared"]
    assert common.checkpoint(frame("local[2]")) == "written"


def test_slices_and_pieces():
    import pyarrow as pa

    from noticelake.llm import common

    batch = pa.RecordBatch.from_arrays([pa.array(["a" * 10, None, "b" * 30, "", "c" * 5]), pa.array(range(5))], names=["text", "i"])
    got = list(common.slices([batch, batch.slice(0, 0)], chars=12, records=2))
    assert [t for _, texts in got for t in texts] == batch.column("text").to_pylist() and [p.num_rows for p, _ in got] == [2, 1, 2]
    assert [i for p, _ in got for i in p.column("i").to_pylist()] == list(range(5))
    text = "wörter und, mehr_wörter " * 700
    cut = list(common.pieces(text, 5000))
    assert "".join(cut) == text and all(len(c) <= 5000 for c in cut) and all(not c[-1].isalnum() and c[-1] != "_" for c in cut)
    assert list(common.pieces("")) == [""] and "".join(common.pieces("x" * 20_000, 5000)) == "x" * 20_000
