"""HTML extraction, token counts, sharding, byte-level BPE."""

import html as entities
import itertools
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import pytest
import tiktoken
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from . import brute
from fundlens.llm import bpe, html, sharding, token_counts


# HTML

def article(page):
    inner = re.search(r"<article>(.*)</article>", page, re.S)[1]
    inner = re.sub(r"<[^>]*>", "\0", re.sub(r"</?b>|<br>", lambda m: " " if m[0] == "<br>" else "", inner))
    return " ".join(filter(None, (re.sub(r"\s+", " ", entities.unescape(t)).strip() for t in inner.split("\0"))))


def test_pages_equal_their_articles(spark, sf):
    from fundlens.llm.queries import queries

    pages = dict(duckdb.sql(f"SELECT page_id, html FROM '{sf}/pages.parquet'").fetchall())
    for r in queries()["op4_html_text"](spark, sf).collect():
        assert r.text == article(pages[r.page_id]) and r.n_chars == len(r.text)


PAGE = """<html><head><title>T</title><style>p{}</style></head><body>
<header><h1>Site</h1></header><div id="cookie-notice">We use cookies.</div>
<div class="nav menu"><a href=/>Home</a> <a href=/x>News, and more</a></div>
<div class="%s"><h1>Headline</h1><p>First &amp; foremost, some prose. It goes on, at length, as prose does.</p>
<p>Short.</p><div class="advert">Buy, now, cheap.</div><p>Last words, of <i>some</i> length, to end it all.</p>
<ul><li>one<li>two</ul></div>
<section class="comments"><p>First! Great, great post, thanks a lot for it.</p></section>
<div class=sidebar><p>Related, other, things.</p></div>
<form><p>Your name, please.</p><input name=a></form><footer>&copy; 2020, all rights.</footer></body></html>"""
MAIN = ("Headline First & foremost, some prose. It goes on, at length, as prose does. Short. "
        "Last words, of some length, to end it all. one two")


@pytest.mark.parametrize("kind", ["content", "x17"])
def test_pages_without_article_tag(kind):
    assert html.main_text(PAGE % kind) == MAIN


def test_unmarked_pages_keep_short_paragraphs():
    long, short = "Prose, of some kind, goes on. " * 34, ("A shorter one, to be kept, with care. " * 3).strip()
    want = " ".join([long.strip(), short, short])
    for page in (f"<div id=page><p>{long}</p><p>{short}</p><p>{short}</p></div>",
                 f"<div id=page><div><p>{long}</p></div><div><p>{short}</p></div><div><p>{short}</p></div></div>",
                 f"<div id=page><p>{long}</p><ul><li>{short}</li><li>{short}</li></ul></div>"):
        assert html.main_text(f"<html><body><div class=nav><a>Menu</a></div>{page}</body></html>") == want
    assert html.main_text(f"<div><p>{short}</p></div>") == short


@pytest.mark.parametrize("tag", ["article", "div class=content", "div"])
def test_ids_of_parts_are_no_boilerplate(tag):
    prose = "Some prose, as it is, goes on."
    page = (f"<{tag}><h2 id='related-work'>Related work</h2><p>{prose}</p><h2 id='search-results'>Results</h2><p>{prose}</p>"
            f"<section id='{'discussion' if tag != 'div' else 'x'}'><p>{prose}</p></section>"
            f"<div class='related'><p>{prose}</p></div></{tag.split()[0]}><div id=comments><p>{prose}</p></div>")
    assert html.main_text(page) == f"Related work {prose} Results {prose} {prose}"


def test_broken_pages():
    for page in (None, "", "   ", "<", "<p", "<!--", "&#xZZ;", "</p></p>", "<script>x", "<p class='a"):
        assert isinstance(html.main_text(page), str)
    assert html.main_text("plain text, no markup.") == "plain text, no markup."
    assert html.main_text("<p>" * 3000 + "deep, deep text.") == "deep, deep text."
    assert html.main_text("<article>" + "<p>a, b.</p>" * 5000 + "</article>") == " ".join(["a, b."] * 5000)


# Token counts

def test_token_counts_equal_unshared_search(spark, sf, documents):
    from fundlens.llm.queries import queries

    c = token_counts.counter(token_counts.default_vocabulary())

    def tokens(word):
        text, best = token_counts.MARK + word, [(0, 0)]
        for end in range(1, len(text) + 1):
            size = len(text[end - 1].encode())
            own = [(best[end - 1][0] + size * c.bytewise, best[end - 1][1] - size)]
            own += [(best[s][0] + c.scores[text[s:end]], best[s][1] - 1) for s in range(end) if text[s:end] in c.scores]
            best.append(max(own))
        return -best[-1][1]

    known = {}
    for r in queries()["op8_token_counts"](spark, sf).collect():
        words = re.findall(f"[^{brute.SPACE}]+", dict(documents)[r.doc_id])
        assert r.n_pretokens == len(words)
        assert r.n_tokens == sum(known.setdefault(w, tokens(w)) if w not in known else known[w] for w in words)


def test_token_count_cases(edges, empty):
    got = {r.doc_id: (r.n_pretokens, r.n_tokens) for r in token_counts.count_tokens(edges).collect()}
    assert got[1] == got[2] == got[3] == (0, 0) and got[4][0] == 1 and got[10][0] == 40_000
    assert token_counts.count_tokens(empty).count() == 0


# Shards

def shards(df):
    out = defaultdict(list)
    for r in df.collect():
        out[r.shard].append(r)
    return out


def test_shards_are_balanced_and_gapless(spark):
    from fundlens.llm.queries import queries

    sf = "/root/testdata/sf0.01"
    texts = dict(duckdb.sql(f"SELECT doc_id, text FROM '{sf}/documents.parquet'").fetchall())
    out = shards(queries()["op9_shards"](spark, sf))
    assert sorted(out) == list(range(sharding.N_SHARDS))
    assert sum(map(len, out.values())) == len(texts)
    largest = max(len(t.encode()) for t in texts.values()) + 16
    sizes = [sum(r.size for r in s) for s in out.values()]
    assert max(sizes) - min(sizes) <= 2 * largest
    for s in out.values():
        assert sorted(r.slot for r in s) == list(range(len(s)))
        for r in s:
            data = texts[r.doc_id].encode()
            assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(data) + 16, zlib.crc32(data), "bytes", None)


def brute_shards(docs, n_shards, whole_share=sharding.WHOLE_SHARE):
    """(id, text) pairs to (id, size, shard, slot), by sorting and adding up."""
    data = [(xxhash.xxh64_intdigest((t or "").encode(), 42), zlib.crc32((t or "").encode()), i, len((t or "").encode()) + 16) for i, t in docs]
    data = sorted((k - (k >> 63 << 64), c, i, n) for k, c, i, n in data)
    total, at, rows = sum(n for *_, n in data), 0, []
    for k, c, i, n in data:
        rows.append([(k, c), i, n, at, (2 * at + n) * n_shards // (2 * total)])
        at += n
    for group, own in itertools.groupby(rows, lambda r: r[0]):
        own = list(own)
        size = sum(r[2] for r in own)
        if own[0][4] != own[-1][4] and size * n_shards <= whole_share * total:
            for r in own:
                r[4] = (2 * own[0][3] + size) * n_shards // (2 * total)
    seen = Counter()
    out = []
    for _, i, n, _, shard in rows:
        out.append((i, n, shard, seen[shard]))
        seen[shard] += 1
    return sorted(out)


@pytest.mark.parametrize("n_shards", [3, sharding.N_SHARDS])
def test_shards_equal_brute_force(spark, sf, documents, n_shards):
    r = random.Random(n_shards)
    copies = [(1000 + n, r.choice(documents[:12])[1]) for n in range(300)]
    for docs in (documents, documents + copies):
        df = spark.createDataFrame(docs, "doc_id long, text string")
        got = sharding.shard_by_bytes(df, n_shards)
        assert sorted((x.doc_id, x.size, x.shard, x.slot) for x in got.collect()) == brute_shards(docs, n_shards)


def test_groups_of_equal_texts_stay_whole(spark):
    docs = [(n, f"text of group {n // 3} " * 20) for n in range(3000)]
    got = sharding.shard_by_bytes(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    of_group, sizes = {}, Counter()
    for r in got:
        of_group.setdefault(r.text_crc32, set()).add(r.shard)
        sizes[r.shard] += r.size
    assert len(of_group) == 1000 and all(len(s) == 1 for s in of_group.values())
    assert max(sizes.values()) - min(sizes.values()) < 0.1 * sum(sizes.values()) / 40
    hot = sharding.shard_by_bytes(spark.createDataFrame([(n, "one text" if n % 3 else f"text {n}") for n in range(3000)], "doc_id long, text string"))
    per = Counter(r.shard for r in hot.collect())
    assert max(per.values()) < 1.2 * min(per.values())


def test_shard_order_does_not_depend_on_partitions(spark, sf):
    from fundlens.llm.queries import table

    docs = table(spark, sf, "documents")
    a, b = (sorted(map(tuple, sharding.shard_by_bytes(docs.repartition(n)).collect())) for n in (1, 7))
    assert a == b


def test_equal_texts_stand_together(spark):
    docs = spark.createDataFrame([(n, f"text {n % 5}") for n in range(500)], "doc_id long, text string")
    out = shards(sharding.shard_by_bytes(docs, 10))
    assert sum(len({r.text_crc32 for r in s}) for s in out.values()) <= 5 + 9
    assert {len(s) for s in out.values()} == {50}


def test_shard_cases(edges, empty):
    out = shards(sharding.shard_by_bytes(edges, 4))
    rows = [r for s in out.values() for r in s]
    assert len(rows) == edges.count()
    assert {(r.size, r.text_crc32) for r in rows if r.doc_id in (1, 2)} == {(16, 0)}
    assert sharding.shard_by_bytes(empty).count() == 0


# Byte-level BPE

@pytest.fixture(scope="module")
def library():
    ranks = bpe.load_ranks(bpe.default_vocabulary())
    return tiktoken.Encoding("own", pat_str=bpe.default_pattern(), mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def codec():
    return bpe.Codec(bpe.default_vocabulary(), bpe.default_pattern())


def test_bpe_query_equals_library(spark, sf, documents, library):
    from fundlens.llm.queries import queries

    for r in queries()["op10_byte_bpe"](spark, sf).collect():
        text = dict(documents)[r.doc_id]
        ids = library.encode_ordinary(text)
        assert (r.n_tokens, r.ids_sha256) == (len(ids), brute.sha(" ".join(map(str, ids))))
        assert r.decoded_sha256 == brute.sha(text)


@settings(max_examples=300, deadline=None)
@given(text=st.one_of(st.text(max_size=60), st.text(alphabet="aeinrst ABC'ls\n\t 019ß漢😀", max_size=120)))
def test_bpe_equals_library(codec, library, text):
    ids = codec.encode(text)
    assert ids == library.encode_ordinary(text) and codec.decode(ids) == text


def test_bpe_of_joined_tokens_and_small_caches(library):
    r, small = random.Random(2), bpe.Codec(bpe.default_vocabulary(), bpe.default_pattern(), max_cached=40)
    vocabulary = sorted(small.transducer.ranks)
    for _ in range(300):
        text = b"".join(r.choice(vocabulary) for _ in range(6)).decode("utf-8", "replace")
        assert small.encode(text) == library.encode_ordinary(text)


def test_bpe_forgets_words_and_states_but_not_the_first_ones(library, documents):
    small = bpe.Codec(bpe.default_vocabulary(), bpe.default_pattern(), max_cached=300, max_words=20)
    for _, text in documents[:100]:
        assert small.encode(text or "") == library.encode_ordinary(text or "")
        t = small.transducer
        assert len(t.states) <= 302 and len(t.steps) <= 1202 and len(small.known.young) <= 10 >= len(small.known.old)
        assert t.states[0] == (b"", ((0, ()),), None) and all(t.number[s] == n for n, s in enumerate(t.states))


def test_recent_keeps_what_is_in_use():
    kept = bpe.Recent(4)
    for n in range(50):
        kept.put(n, -n)
        if n:
            assert kept.get("used") == 1
        else:
            kept.put("used", 1)
    assert kept.get(49) == -49 and kept.get(3) is None and len(kept.young) + len(kept.old) <= 4


def test_bpe_long_pieces_in_linear_time(codec):
    for text in ("a" * 100_000, "ab" * 50_000, " " * 50_000 + "x", "\n" * 50_000, "é" * 30_000):
        assert codec.decode(codec.encode(text)) == text


def test_streaming_decode_waits_for_whole_characters(codec):
    ids = [codec.transducer.ranks[bytes([b])] for b in "é漢😀".encode()]
    assert list(codec.decoder.stream(ids)) == ["é", "漢", "😀"]
    assert codec.decode(ids[:3]) == "é�"


def test_bpe_cases(edges, empty):
    got = {r.doc_id: r for r in bpe.encode_documents(edges).collect()}
    assert got[1].n_tokens == got[2].n_tokens == 0 and got[1].ids_sha256 == brute.sha("") == got[2].decoded_sha256
    texts = {r.doc_id: r.text for r in edges.collect()}
    assert all(r.decoded_sha256 == brute.sha(texts[i] or "") for i, r in got.items())
    assert bpe.encode_documents(empty).count() == 0
    ids = edges.select("doc_id", "text", bpe.encode_ids("text").alias("ids"))
    back = ids.select("text", bpe.decode_ids("ids").alias("back")).collect()
    assert all(r.text == r.back for r in back)
