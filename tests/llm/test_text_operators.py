"""Personal data, secrets, page text and token counts: rules against plain forms of them."""

import hashlib
import html
import random
import re

import pytest

from roadrisk.llm import html_text, pii, secrets, tokens

public_tokenizers = pytest.importorskip("public_tokenizers")


def rand_texts(alphabet, n, size, seed):
    r = random.Random(seed)
    return ["".join(r.choice(alphabet) for _ in range(size)) for _ in range(n)]


def plain_pii(t):
    found = [(m.start(), m.end(), "email") for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t):
        if all(int(p) <= 255 for p in m[0].split(".")):
            found.append((m.start(), m.end(), "ip"))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = re.sub("[^0-9]", "", m[0])
        if 14 <= len(d) <= 19 and pii.luhn(d):
            found.append((m.start(), m.end(), "card"))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t):
        if 10 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            found.append((m.start(), m.end(), "phone"))
    return sorted(found, key=lambda s: (s[0], pii.RANK[s[2]]))


def test_pii_base_spans_follow_the_plain_patterns():
    texts = (rand_texts("ab1.2@@-3 +%_5", 4000, 60, 1) + rand_texts("0123456789.", 1500, 40, 2)
             + rand_texts("4567+- ().", 1500, 40, 3) + ["é a.b@c-d.ef 1.2.3.4.5.6.7.8 4111 1111 1111 1111"])
    for t in texts:
        assert pii.base_spans(t) == plain_pii(t), t


def test_pii_checks():
    assert pii.luhn("4111111111111111") and not pii.luhn("4111111111111112")
    assert pii.mod97("GB82 WEST 1234 5698 7654 32") and not pii.mod97("GB82 WEST 1234 5698 7654 33")


def test_pii_context_decides_the_looser_kinds():
    kinds = lambda t: [s[2] for s in pii.find(t)]
    assert kinds("IBAN GB82 WEST 1234 5698 7654 32 thanks") == ["iban"]
    assert kinds("please call (212) 555-0123 now") == ["phone_local"]
    assert kinds("the code (212) 555-0123 stands") == []
    assert kinds("her ssn is 219-09-9999") == ["ssn"]
    assert kinds("part 219-09-9999") == []
    # a base span is never displaced and never scored away
    assert kinds("version 1.2.3.4") == ["ip"]
    assert kinds("call +1 (212) 555-0123") == ["phone"]


def test_pii_very_long_runs_stay_linear():
    for t in ("a" * 400_000, "1" * 400_000, "1." * 200_000, "+1" + " " * 400_000, "1 " * 200_000, "a@" * 200_000, "9" * 5000 + ".1.1.1"):
        pii.find(t)


def plain_secrets(t):
    rule = re.compile(r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
    found = [(m.start(), m.end(), "assign") for m in rule.finditer(t) if len(m[2]) >= 12]
    found += [(m.start(), m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 18]
    found += [(m.start(), m.end(), "hex") for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 16]
    return sorted(found, key=lambda s: (s[0], secrets.RANK[s[2]]))


def test_secret_base_spans_follow_the_plain_patterns():
    r = random.Random(4)
    parts = ["ToKen", "api_key", "apiKEY", "secret ", '"', "'", " ", ":", "=", "abc123", "deadbeef0", "AKIA", "ZZZ99", "=/", "passwd", "ſecret", "é"]
    for _ in range(4000):
        t = "".join(r.choice(parts) for _ in range(12))
        assert [s[:3] for s in secrets.base_spans(t, t.encode())] == plain_secrets(t), t


def test_automaton_takes_its_format_and_leaves_others():
    r = random.Random(5)
    upper, mixed = "ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789"
    key = lambda chars, n: "".join(r.choice(chars) for _ in range(n))
    learned = secrets.Automaton([("AKIA" + key(upper, 16)).translate(secrets.SYMBOL) for _ in range(300)])
    fresh = ["AKIA" + key(upper, 16) for _ in range(200)]
    assert sum(secrets.accepted(t, {"access": learned}) is not None for t in fresh) >= 180
    assert sum(secrets.accepted(key(mixed, 20), {"access": learned}) is not None for _ in range(200)) <= 2
    assert secrets.accepted("internationalisation2", {"access": learned}) is None
    assert len(learned.next) > 0 and learned.likelihood("?") == -99.0


def test_secret_candidates_exclude_base_spans():
    t = 'token = "0123456789abcdef0123" and ZQ7XK2PLM9AB4CD8EF and averyveryverylongword'
    base = secrets.base_spans(t, t.encode())
    assert [c[2] for c in secrets.candidates(t, base)] == ["ZQ7XK2PLM9AB4CD8EF"]


PAGE = """<!DOCTYPE html><html><head><title>T &amp; t</title><style>p{}</style><script>var x="</p><p>no</p>";</script></head>
<body><header><h1>Site name</h1></header><nav><ul><li><a href="/">Home</a></li></ul></nav>
<div id="cookie-notice">We use cookies, many cookies, and more cookies than you think.</div>
<div class="%s"><h1>Title</h1><p>First &lt;para&gt;, with <b>bold</b> text
 and a   line break, and enough words to count as prose here.<br><p>Second one, unclosed, that also is long enough to count, we think.
<div class="share-buttons"><a href="#">Share</a></div><form><p>Your mail, your name, your everything, please enter it here now.</p></form></div>
<!-- <p>hidden</p> --><div class="comments"><p>A reader says, at length, that this is wrong, wrong, wrong.</p></div>
<aside><p>Related, and related, and again related things to read next.</p></aside><footer>&copy; 2024 all, of it</footer></body></html>"""
WANT = ("Title First <para>, with bold text and a line break, and enough words to count as prose here. "
        "Second one, unclosed, that also is long enough to count, we think.")


@pytest.mark.parametrize("page", [PAGE % "content", (PAGE % "x").replace('<div class="x">', "<article>").replace("</form></div>", "</form></article>")])
def test_html_keeps_the_article_only(page):
    assert html_text.main_text(page) == WANT


@pytest.mark.parametrize("page", [None, "", "<", "<p", "<html><body></body></html>", "<script>a<b", "</div></p>", "<!-- x", "<a href='", "<" * 5000])
def test_html_without_text(page):
    assert html_text.main_text(page).strip("<") == ""


def test_html_every_prefix_is_accepted():
    page = PAGE % "content"
    for i in range(0, len(page), 7):
        html_text.main_text(page[:i])


@pytest.mark.parametrize("code", [
    "for(i=0;i<n;i++){x()}", "if(a<b) go() // we don't", 'x = "<!-- "; y()', "a<b", "// <i don't", "s = '</scripts>'", "<!--"])
@pytest.mark.parametrize("tag", ["script", "STYLE", "noscript"])
def test_html_raw_text_ends_at_its_own_end_tag(code, tag):
    page = f"<body><{tag}>{code}</{tag.title()} ><article><p>All of this is the article.</p><template><script>{code}</script></template><p>End.</p></article>"
    assert html_text.main_text(page) == "All of this is the article. End."


LONG = "".join(f"<p>Paragraph {i}, of the long body, with a comma, and another, and enough words, one thinks.</p>" for i in range(40))
NAV = "<div><a href='/'>Home of the site</a> <a href='/n'>News of the day, all of it</a></div>"


@pytest.mark.parametrize("n", [1, 3, 40])
@pytest.mark.parametrize("start, end", [("<article>", "</article>"), ("<main>", "</main>"), ("<div class=wrap>", "</div>"), ("<main><article>", "</article></main>")])
def test_html_nested_sections_are_kept_whatever_the_length(n, start, end):
    body = "</p>".join(LONG.split("</p>")[:n]) + "</p>"
    inner = (f"<h1>T</h1><div class=body>{body}</div><div><p>Lone one.</p><section><p>Short, but a section of its own.</p></section></div>"
             "<p>Bye.</p>Loose <i>inline</i> text")
    want = " ".join(re.sub(r"<[ib/][^p>]*>|<[^>]*>", lambda m: "" if m[0] in ("<i>", "</i>") else " ", inner).split())
    assert html_text.main_text(f"<body>{NAV}<nav>no</nav>{start}{inner}{end}{NAV}</body>") == want


def test_html_link_blocks_beside_the_container_go():
    links = "<ul><li><a href='/1'>One more story to read</a></li><li><a href='/2'>Another story to read</a></li></ul>"
    page = f"<body><div>{NAV}<div>Before<div>{LONG}</div>{links}<p>After, with <a href='#'>a link</a> in the text.</p></div></div></body>"
    text = html_text.main_text(page)
    assert text.startswith("Before Paragraph 0,") and text.endswith("one thinks. After, with a link in the text.") and "story" not in text


def test_html_deep_inline_nesting_stays_linear():
    assert html_text.main_text("<span>" * 30_000 + "<p>deep</p>") == "deep"


def test_html_many_raw_elements_stay_linear():
    assert html_text.main_text("<p>a</p>" + "<script>i<n" * 100_000) == "a"
    assert html_text.main_text("<script>i<n</script>" * 100_000 + "<p>a</p>") == "a"


def test_html_deep_nesting_and_entities():
    assert html_text.main_text("<div>" * 3000 + "<p>deep &eacute; &#233; &nbsp;x &unknown; &am</p>") == "deep é é x &unknown; &am"


def test_html_pages_against_their_article(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").select("html").collect()
    for r in rows:
        m = re.search(r"<article>(.*?)(</article>|$)", r["html"], re.S)
        inner = re.sub(r"<[^>]*>", " ", re.sub(r"</?b>", "", m[1]))
        assert html_text.main_text(r["html"]) == " ".join(html.unescape(inner).split())


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def test_spliced_token_counts_equal_whole_texts(tokenizer):
    r = random.Random(6)
    pieces = ["word", " and", "  \n\n ", "<|endoftext|>", "日本語", "é" * 9, "don't we'll", "🙂🙂", "x" * 300, "12345" * 30, "<|endof", "text|>", " ", "\n", ".,!"]
    texts = ["".join(r.choice(pieces) for _ in range(300)) for _ in range(30)]
    texts += ["a" * 4000, " " * 4000, "\n" * 3000 + "a", "ab " * 2000, "<|endoftext|>" * 300, "日" * 3000]
    for t in texts:
        want = len(tokenizer.encode(t, add_special_tokens=False).ids)
        for chunk, overlap in ((400, 100), (900, 70), (1500, 600)):
            assert tokens.count_spliced(t, tokenizer, chunk, overlap) == want


def test_text_queries_over_odd_tables(spark):
    """Nulls, empty and repeated rows, clashing extra columns, an empty table."""
    rows = [(1, "mail a@b.co 10.0.0.1"), (1, "mail a@b.co 10.0.0.1"), (2, None), (None, ""), (3, "password=abcdefghijkl1"), (4, "x " * 100_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as n_email", "'k' as spans", "0 as kind", "0 as h")
    found = {(r["doc_id"], r["spans"]) for r in pii.personal_data(docs).collect()}
    assert found == {(1, "email:5:11,ip:12:20"), (2, ""), (None, ""), (3, ""), (4, "")}
    got = [r for r in secrets.secrets(docs).collect()]
    assert len(got) == 6 and [r["spans"] for r in got if r["doc_id"] == 3] == ["assign:0:22"]
    assert all(r["base_sha256"] == hashlib.sha256(b"").hexdigest() for r in got if not r["spans"])
    counts = {r["doc_id"]: (r["n_bytes"], r["n_tokens"] > 0, r["over_limit"]) for r in tokens.token_counts(
        docs, public_tokenizers.path("byte_bpe_50k.json"), chunk=4096).collect()}
    assert counts[2] == (0, False, False) and counts[4] == (200_000, True, True)
    assert [r["text"] for r in pii.redact(docs.filter("doc_id <= 2")).collect()] == ["mail <email> <ip>"] * 2 + [None]
    empty = docs.limit(0)
    assert pii.personal_data(empty).count() == secrets.secrets(empty).count() == 0
    assert tokens.token_counts(empty, public_tokenizers.path("byte_bpe_50k.json")).count() == 0
    pages = spark.createDataFrame([(1, "u", None), (1, "u", None), (None, None, "<p>a</p>")], "page_id long, url string, html string").selectExpr("*", "'x' as text")
    assert sorted(r["text"] for r in html_text.page_texts(pages).collect()) == ["", "", "a"]
    assert html_text.page_texts(pages.limit(0)).count() == 0
