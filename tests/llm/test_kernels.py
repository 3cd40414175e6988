"""Kernels against brute force, without Spark."""

import base64
import random

import numpy as np
import public_tokenizers as P
import pytest

from docflow.llm import bpe, extract, langid, packing, simhash, topk, vecdedup, wordpiece
from docflow.llm.components import local_labels, tree_edges

PIECES = [*"abc AB\t\n\r½!?'s", " ", "　", "\x1c", "\x85", "é", "漢", "字", "２", "🎉", "'ll", "<|endoftext|>", "𝔘"]


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(1)
    return ["".join(rng.choice(PIECES) for _ in range(rng.randint(0, 80))) for _ in range(400)] + ["a" * 1000, "ab" * 700 + " the" * 3, "x" * 257, ""]


def test_bpe_equals_the_libraries_and_comes_back(texts):
    import tiktoken
    from tokenizers import Tokenizer

    path = P.path("byte_bpe_multi_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    other = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    codec = bpe.ranks_codec(path, P.PATTERN)
    ids, begins = codec.encode(texts)
    for t, a, b in zip(texts, begins, begins[1:]):
        assert ids[a:b].tolist() == other.encode_ordinary(t)
        assert codec.decode(ids[a:b].astype(np.int64)).tobytes() == t.encode()
    assert codec.decode(np.array([-1, 10**6, 5])).tobytes() == codec.decode(np.array([5])).tobytes()
    merges, tok = bpe.merges_codec(P.path("byte_bpe_50k.json"), P.PATTERN), Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    ids, begins = merges.encode(texts)
    for t, a, b in zip(texts, begins, begins[1:]):
        assert ids[a:b].tolist() == tok.encode(t, add_special_tokens=False).ids


def test_bpe_of_very_long_rows(monkeypatch):
    import tiktoken

    rng = random.Random(4)
    path = P.path("byte_bpe_multi_50k.tiktoken")
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(path, "rb"))}
    other = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    codec = bpe.ranks_codec(path, P.PATTERN)
    rows = ["".join(rng.choice(alphabet) for _ in range(n)) for alphabet in ("ab", "abcdefghijklmnopqrstuvwxyz", "aeinrst", "éüа漢字") for n in (300, 2500, 9000)]
    rows += ["=" * 20_000, "ab" * 9000, "a" * 4097, "thethatthen" * 1000]
    want = [other.encode_ordinary(t) for t in rows]
    for long_row in (bpe.LONG_ROW, 1):
        monkeypatch.setattr(bpe, "LONG_ROW", long_row)
        codec.forget()
        ids, begins = codec.encode(rows)
        assert [ids[a:b].tolist() for a, b in zip(begins, begins[1:])] == want


def test_bpe_cache_may_be_emptied(texts, monkeypatch):
    codec = bpe.ranks_codec(P.path("byte_bpe_multi_50k.tiktoken"), P.PATTERN)
    want = codec.encode(texts)[0].tolist()
    monkeypatch.setattr(bpe, "CACHE_PIECES", 3)
    assert codec.encode(texts[:200])[0].tolist() + codec.encode(texts[200:])[0].tolist() == want


def longest_match(word, first, rest):
    at = n = 0
    while at < len(word):
        known = rest if at else first
        end = next((j for j in range(len(word), at, -1) if word[at:j] in known), None)
        if end is None:
            return 1
        at, n = end, n + 1
    return n


def test_automaton_counts_greedy_pieces():
    rng = random.Random(3)
    for _ in range(60):
        word = lambda k: "".join(rng.choice("abc") for _ in range(rng.randint(1, k))).encode()
        first, rest = {word(4) for _ in range(rng.randint(1, 8))}, {word(4) for _ in range(rng.randint(1, 8))}
        words = [word(12) for _ in range(80)] + [b""]
        assert wordpiece.Automaton(sorted(first), sorted(rest)).counts(words).tolist() == [longest_match(w, first, rest) for w in words]


def test_trie_pairs_and_labels():
    rng = np.random.default_rng(0)
    for trial in range(12):
        n = int(rng.integers(2, 150))
        base = rng.integers(0, 2**63, size=max(1, n // 8), dtype=np.uint64)
        c = base[rng.integers(0, len(base), n)]
        for _ in range(4):
            c = np.where(rng.random(n) < 0.6, c ^ (np.uint64(1) << rng.integers(0, 64, n).astype(np.uint64)), c)
        roots = rng.integers(0, 3, n)
        o = np.lexsort((c, roots))
        c, roots = c[o], roots[o]
        for budget in (0, 1, 4):
            want = {(i, j) for i in range(n) for j in range(i + 1, n) if roots[i] == roots[j] and int(c[i] ^ c[j]).bit_count() <= budget}
            got = [(int(i), int(j)) for x, y in simhash.trie_pairs(c, roots, budget) for i, j in zip(x, y)]
            assert len(got) == len(set(got)) and set(got) == want
            a, b = np.array(sorted(want), int).reshape(-1, 2).T
            assert (simhash.linked(c, roots, budget) == local_labels(n, a, b)).all()


def test_tree_edges_span_each_label():
    labels, nodes = np.repeat([0, 5], [200, 3]), np.arange(203)[::-1].copy()
    a, b = tree_edges(labels, nodes)
    got = local_labels(203, a, b)
    assert len(a) == 201 and len(set(got.tolist())) == 2 and np.bincount(np.concatenate([a, b])).max() <= 66


def test_masks_meet_every_small_difference():
    rng = random.Random(2)
    for blocks in (5, 6, 7):
        choices = simhash.masks(list(range(64)), 4, blocks)
        for _ in range(200):
            wrong = set(rng.sample(range(64), 4))
            assert any(not wrong & set(m) for m in choices)


def test_top_k_block_is_exact():
    rng = np.random.default_rng(0)
    for trial in range(150):
        n, d, k, m = int(rng.integers(1, 200)), int(rng.integers(0, 6)), int(rng.integers(1, 6)), int(rng.integers(1, 9))
        x, ids, q, own = rng.integers(-5, 6, (n, d)).astype(float), rng.permutation(n) // (1 + trial % 2), rng.integers(-5, 6, (m, d)).astype(float), rng.integers(0, n, m)
        full = [sorted({i: max((int(x[r] @ q[j]) for r in np.flatnonzero(ids == i)), default=0) for i in ids.tolist() if i != own[j]}.items(), key=lambda e: (-e[1], e[0])) for j in range(m)]
        for reached in (np.full(m, -np.inf), np.array([float(f[min(k, len(f)) - 1][1]) if len(f) >= k else -np.inf for f in full])):
            block = topk.Block(ids, x)
            place, rows, scores = block.best(q, own, k, reached)
            place, found, scores = topk.k_best(place, ids[rows], scores, k)
            for j in range(m):
                assert list(zip(found[place == j].tolist(), scores[place == j].tolist())) == full[j][:k]


def test_top_k_reads_less_than_the_lists():
    rng = np.random.default_rng(1)
    x = np.floor(1024 * vecdedup.unit(rng.normal(size=(2048, 64))))
    q = np.floor(1024 * vecdedup.unit(x[:40] + 60 * rng.normal(size=(40, 64))))
    reached = np.partition(q @ x.T, -10, axis=1)[:, -10]
    block = topk.Block(np.arange(2048), x)
    place, _, _ = block.best(q, np.full(40, -1), 10, reached)
    assert 400 <= len(place) < 440 and 0 < block.read < 0.75 * 40 * x.size
    block.read = 0
    assert not len(block.best(q, np.full(40, -1), 10, np.full(40, 1e9))[0]) and block.read == 0  # no row can reach it: nothing is read


def test_vector_graph_finds_its_neighbours():
    rng = np.random.default_rng(1)
    base = rng.normal(size=(600, 32))
    x = vecdedup.unit(np.concatenate([base, base[:60] + 0.1 * rng.normal(size=(60, 32)), base[:1] + 0.05 * rng.normal(size=(90, 32))]))
    graph = vecdedup.both_ways(vecdedup.build(x.astype(np.float32)))
    q = np.arange(len(x))
    a, b = vecdedup.in_range(x.astype(np.float32), graph, q, np.stack([np.zeros(len(x), int), q], 1), 48, 0.9)
    true = x @ x.T >= 0.9
    found = np.zeros_like(true)
    found[a, b] = found[b, a] = True
    assert (found & true).sum() >= 0.99 * true.sum() and graph.max() < len(x)
    assert (vecdedup.build(x[:1].astype(np.float32)) == -1).all()


@pytest.mark.parametrize("rule", ["norm", "dot"])
def test_packing_respects_every_capacity(rule):
    rng = np.random.default_rng(4)
    size = rng.integers(1, 1025, 3000)
    seq, off = packing.vector_best_fit(size, 1024, 5, 700_000, rule=rule)
    for s in np.unique(seq):
        m = seq == s
        o = np.argsort(off[m])
        assert (off[m][o] == np.cumsum(size[m][o]) - size[m][o]).all() and size[m].sum() <= 1024
        assert m.sum() == 1 or m.sum() <= 5 and (size[m] ** 2).sum() <= 700_000
    free, _ = packing.vector_best_fit(size, 1024, 1024, 1 << 20, rule=rule)
    assert free.max() + 1 <= 1.02 * -(-size.sum() // 1024)
    assert len(packing.vector_best_fit(np.zeros(0, int), 8, 8, 64)[0]) == 0


def test_html_rules():
    page = """<html><head><title>no</title><style>p{}</style></head><body><header>top</header><nav><ul><li><a href=x>menu</a></ul></nav><div class="cookie notice">we use cookies</div>
    <article><h1>Head &amp; line</h1><p>Short.<p>The   quick fox and the dog are in the house of the king, and it is not a joke at all.<br>more</p><div class="comments"><p>reader says the thing that is not in the text of it</div><form>ask</form></article>
    <aside>side</aside><script>if (a < b) "</p>"</script><footer>&copy; all</footer>"""
    assert extract.main_text(page) == "Head & line\nShort.\nThe quick fox and the dog are in the house of the king, and it is not a joke at all. more"
    plain = "<div><a href=1>home</a> <a href=2>about</a></div><p>Tiny</p><p>The text of the page is here and it is as long as it has to be to be of use to the one who reads it.</p><p>End.</p><div><a href=3>next</a></div>"
    assert "The text of the page" in extract.main_text(plain) and "home" not in extract.main_text(plain) and "next" not in extract.main_text(plain)
    assert extract.main_text(None) == extract.main_text("") == extract.main_text("<nav>x</nav>") == "" and extract.main_text("a < b <") in ("", "a < b <")


def test_backoff_goes_from_words_to_shorter_grams():
    m = langid.Model([("en", 0, "the", 5), ("de", 0, "der", 5), ("en", 2, "th", 4), ("de", 2, "de", 4), ("en", 1, "t", 3), ("de", 1, "d", 3)])
    assert m.decide(m.word("the"), 1)[0] == "en" and m.decide(m.word("deppen"), 1)[0] == "de" and m.decide(m.word("t"), 1)[0] == "en"
    assert (m.word("xyz") == langid.ABSENT).all()


WORDS = "the of and river garden window with a letter to morning under".split()


def made_page(rng):
    """A page and the text of its article, written down side by side."""
    sentence = lambda k: " ".join(rng.choice(WORDS) for _ in range(rng.randint(1, k)))
    spaces = lambda t: "".join(rng.choice([" ", "\n", "  ", "\t", "&#32;"]) if c == " " else c for c in t)
    raw, want = [], []

    def apart():
        return rng.choice([
            f"<nav><ul><li><a href=/x>{sentence(4)}</a><li>{sentence(20)}</ul></nav>", f"<aside class=it's><p>{sentence(40)}</aside>", f"<form><p>{sentence(30)}</p><textarea><p>{sentence(9)}</textarea></form>",
            f"<script>var t='</p><article>{sentence(5)}';</script>", f"<style>p > a {{ content: '<p>' }}</style>", f"<!-- <p>{sentence(9)}</p> -->", f'<div class="cookie notice">{sentence(60)}</div>', f"<section id=comments><article><p>{sentence(50)}</article></section>",
        ])

    raw.append(f"<!DOCTYPE html><html><head><title>{sentence(9)}</title></head><body><header><h1>{sentence(30)}</h1></header>{apart()}<article lang=en>")
    for _ in range(rng.randint(1, 7)):
        t = sentence(rng.choice([3, 40]))
        kind = rng.randrange(7)
        if kind == 0:
            raw.append(f"<p title='a > b' data-x=\"<p>\">{spaces(t)}</p>")
        elif kind == 1:
            raw.append(f"<p title=it's><a href='/y'>{spaces(t)}</a>")
        elif kind == 2:
            raw.append(f"<figure><img src=a alt='{sentence(3)}'><figcaption>{spaces(t)}</figcaption></figure>")
        elif kind == 3:
            raw.append(f"<ul><li>{t}<li><b>&lt;{t}&GT; &eacute;&#233;&#x00000000e9;</b></ul>")
            want.append(t)
            t = f"<{t}> ééé"
        elif kind == 4:
            raw.append(f"<blockquote><P>{t} &amp;amp; &copy</P></blockquote>")
            t += " &amp; ©"
        elif kind == 5:
            raw.append(f"<h2>{t}</h2>")
        else:
            raw.append(f"<table><tr><td>{t}<td>{t}</table>")
            want.append(t)
        want.append(t)
        if rng.random() < 0.3:
            raw.append(apart())
    raw.append(f"</article>{apart()}<footer>{sentence(30)}</footer></body></html>")
    return "".join(raw), "\n".join(want)


def test_text_of_made_pages():
    rng = random.Random(7)
    for _ in range(300):
        page, want = made_page(rng)
        assert extract.main_text(page) == want, page


@pytest.mark.parametrize("part", ["<a ", '<p title="', "<p title='", "<script ", "<script>", "<!--", "<", "</", "&#9", "<p a=\"'", "<style></styl", "&"])
def test_long_pages_take_linear_time(part):
    import time

    page = "<article><p>text</p></article>" + part * (1_000_000 // len(part))
    began = time.process_time()
    assert extract.main_text(page).startswith("text")
    assert time.process_time() - began < 10
    assert extract.main_text("<p>" + "word of the " * 90_000).count("word") == 90_000


def test_deep_pages_take_linear_time():
    for page in ("<b>" * 40_000 + "</i>" * 40_000, "<b><article>" + "<i>" * 40_000 + "</b>" * 40_000, "<div>" * 40_000 + "</p>" * 40_000, "&#" + "9" * 50_000 + ";"):
        extract.main_text(page + "<article><p>text</p></article>")
