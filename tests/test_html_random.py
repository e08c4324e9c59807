"""The token-table cleaner against a tree cleaner on the standard library's
parser, over random pages: nested blocks, left-out end tags, stray end tags,
odd attributes, comments, scripts, banners, headings, footnotes, math, links."""

import random
from html.parser import HTMLParser

from elcorpus.plans import clean as C
from elcorpus.profile import FR_BOILERPLATE_HEADINGS

N_PAGES = 2000
VOID = {"br", "img", "hr", "wbr", "meta", "link", "input"}
ENDS_P = {"address", "article", "aside", "blockquote", "div", "dl", "fieldset", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "header",
          "hr", "main", "nav", "ol", "p", "pre", "section", "table", "ul", "li", "dt", "dd", "td", "th", "tr"}
SCOPE = {"li": {"ul", "ol"}, "dt": {"dl"}, "dd": {"dl"}, "td": {"tr", "table"}, "tr": {"table"}}


class Node:
    def __init__(self, tag, attrs=(), parent=None):
        self.tag, self.parent, self.kids = tag, parent, []
        self.attrs = {}
        for k, v in attrs:
            self.attrs.setdefault(k, v or "")

    def classes(self):
        return self.attrs.get("class", "").split()

    def walk(self):
        for k in list(self.kids):
            if isinstance(k, Node):
                yield k
                yield from k.walk()

    def text(self):
        return "".join(k if isinstance(k, str) else "" if k.tag in ("script", "style") else k.text() for k in self.kids)

    def replace(self, with_text=None):
        at = next(i for i, k in enumerate(self.parent.kids) if k is self)
        self.parent.kids[at:at + 1] = [] if with_text is None else [with_text]


class Tree(HTMLParser):
    def __init__(self, page):
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("#root")
        self.feed(page)
        self.close()

    def open_tags(self):
        out, n = [], self.at
        while n.parent is not None:
            out.append(n)
            n = n.parent
        return out  # innermost first

    def end(self, names, scope):
        for n in self.open_tags():
            if n.tag in names:
                self.at = n.parent
                return
            if n.tag in scope:
                return

    def handle_starttag(self, tag, attrs):
        if tag in SCOPE:
            self.end({"dt", "dd"} if tag in ("dt", "dd") else {tag}, SCOPE[tag] | {"table", "td"} - {tag})
        if tag in ENDS_P:
            self.end({"p"}, {"table", "td", "button", "object", "caption"})
        node = Node(tag, attrs, self.at)
        self.at.kids.append(node)
        if tag not in VOID:
            self.at = node

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.at = self.at.parent

    def handle_endtag(self, tag):
        block = {"div", "ul", "ol", "li", "table", "tr", "td", "dl", "dt", "dd", "section", "blockquote", "body", "html"}
        stop = {"div": {"td", "table"}, "ul": {"td", "table"}, "table": set(), "li": {"ul", "ol", "table", "td"}, "td": {"table"}, "tr": {"table"},
                "dl": {"td", "table"}, "dd": {"dl", "td", "table"}, "section": {"td", "table"}}.get(tag, block)
        if tag in ("h1", "h2", "h3"):
            stop = {"table", "td"}
        self.end({tag}, stop)

    def handle_data(self, data):
        self.at.kids.append(data)


def internal(n):
    good = {"Paris", "A B", "Été", "L'Île"}
    return n.tag == "a" and n.attrs.get("href", "") in ("/wiki/Paris", "/wiki/A_B", "/wiki/%C3%89t%C3%A9") and n.attrs.get("title") in good


def expected(page):
    """(status, qid, text)"""
    root = Tree(page).root
    if any(n.tag == "div" and "noarticletext" in n.classes() for n in root.walk()):
        return "ok", "", ""
    links = [n.attrs["href"] for n in root.walk() if n.tag == "a" and n.attrs.get("href", "").startswith("https://www.wikidata.org/wiki/Special:EntityPage/Q")]
    qid = links[0].split("/")[-1] if links else ""
    main = root
    for key, value in (("id", "mw-content-text"), ("class", "mw-parser-output")):
        main = next((n for n in main.walk() if n.tag == "div" and (n.attrs.get("id") == value if key == "id" else value in n.classes())), None)
        if main is None:
            return "error", qid, ""
    for n in list(main.walk()):
        if (n.tag == "span" and "mw-editsection" in n.classes()) or {"bandeau-container", "infobox", "infobox_v3"} & set(n.classes()):
            n.replace()
    order = list(main.walk())
    for i, n in enumerate(order):
        if n.tag.startswith("h") and n.text().lower().strip() in FR_BOILERPLATE_HEADINGS:
            for later in order[i:]:
                if any(k is later for k in later.parent.kids):
                    later.replace()
            break
    paragraphs = [k for k in main.kids if isinstance(k, Node) and k.tag == "p"]
    out = []
    for p in paragraphs:
        for n in list(p.walk()):
            if n.tag == "sup":
                n.replace()
        for n in list(p.walk()):
            if n.tag == "span" and "mwe-math-element" in n.classes():
                img = next((k for k in n.walk() if k.tag == "img"), None)
                if img is not None and "alt" not in img.attrs:
                    return "error", qid, ""
                text = n.text().replace("\n", "")
                at = text.find("{\\displaystyle")
                n.replace(img.attrs["alt"] if img is not None else text[:at])
        for n in list(p.walk()):
            if internal(n):
                n.replace(f"[E={n.attrs['title'].replace(' ', '_')}]{n.text()}[/E]")
        out.append(p.text())
    return "ok", qid, "\n".join(out).strip()


class Pages:
    def __init__(self, seed):
        self.r = random.Random(seed)

    def words(self):
        pool = ["un", "deux", "été", "a &amp; b", "&lt;x&gt;", "1 &#233; 2", "&nosuch;", "&eacute;t&eacute;", "fin.", "x\ny", "  ", "&#x41;", "{ }"]
        return " ".join(self.r.choice(pool) for _ in range(self.r.randint(1, 5)))

    def attrs(self):
        return self.r.choice(["", "", "", ' data-x="a > b"', " id=q1", " class='c1 c2'", ' data-y=\'<p title="z">\'', ' title="class=\'infobox\'"'])

    def inline(self, depth=0, link=True):
        r = self.r
        k = r.randint(0, 11)
        if depth > 2 or k <= 3:
            return self.words()
        inner = self.inlines(depth + 1, link)
        if k == 4:
            return f"<b{self.attrs()}>{inner}</b>"
        if k == 5:
            return f"<I>{inner}" + r.choice(["</I>", "</i>", "</b></i>"])
        if k == 6 and link:
            href = r.choice(["/wiki/Paris", "/wiki/A_B", "/wiki/%C3%89t%C3%A9", "/wiki/Paris#Vie", "/w/index.php?t=1", "/wiki/Projet:X", "https://x.org/wiki/Paris"])
            title = r.choice([' title="Paris"', ' title="A B"', " title='Été'", ' title="L&#39;Île"', ' title="Projet:X"', ' title="Paris#V"', ""])
            return f'<a href="{href}"{title}>{self.inlines(depth + 1, False)}</a>'
        if k == 7:
            return f"<sup{self.attrs()}>{inner}</sup>"
        if k == 8:
            math = r.choice(['<img alt="m &lt; n">', "x\ny {\\displaystyle z}", "abc", "<i>q</i>r{\\displaystyle w}", '<img src="a>b" alt="k"/>'] + ['<img src="m">'] * (r.random() < 0.05))
            return f'<span class="mwe-math-element x">{math}</span>'
        if k == 9:
            return r.choice(["<!-- <p>no</p> -->", "<br>", "<BR/>", "<script>var a = '<p>no</p>';</script>", "<style>p > b {}</style>", "</u>", "<wbr>"])
        if k == 10 and link:  # a link inside a link is read in many ways
            return '<span class="mw-editsection">[<a href="/wiki/Paris" title="Paris">e</a>]</span>'
        return f"<span>{inner}</span>"

    def inlines(self, depth=0, link=True):
        return "".join(self.inline(depth, link) for _ in range(self.r.randint(1, 3)))

    def block(self, depth=0):
        r = self.r
        k = r.randint(0, 12)
        if depth > 2 or k <= 4:
            return f"<p{self.attrs()}>{self.inlines()}" + r.choice(["</p>", "</p>", "\n</p>", "", "<b>open"]) + r.choice(["", "\n"])
        if k == 5:
            return "<ul>" + "".join(f"<li>{self.inlines()}" + r.choice(["</li>", ""]) for _ in range(r.randint(1, 3))) + "</ul>"
        if k == 6:
            cells = "".join(f"<td>{self.block(depth + 1)}" + r.choice(["</td>", ""]) for _ in range(2))
            return f"<table{r.choice(['', ' class=\"infobox v\"', ' class=infobox_v3'])}><tr>{cells}" + r.choice(["</tr>", ""]) + "</table>"
        if k == 7:
            return f"<div{r.choice(['', ' class=\"bandeau-container x\"', ' class=\"infoboxes\"'])}>" + "".join(self.block(depth + 1) for _ in range(r.randint(1, 2))) + "</div>"
        if k == 8:
            title = r.choice(["Histoire", "Vie", r.choice(FR_BOILERPLATE_HEADINGS).title() if r.random() < 0.3 else "Lieu"])
            mark = r.choice([title, f"<span> {title}</span>", f'{title}<span class="mw-editsection">[m]</span>', f"<i>{title}</i>\n"])
            return f"<h2>{mark}</h2>"
        if k == 9:
            return "<dl><dt>" + self.inlines() + r.choice(["</dt>", ""]) + "<dd>" + self.inlines() + "</dl>"
        if k == 10:
            return r.choice(["</div-x>", "</b>", "</li>", "<hr>", "<!-- c > d -->", "texte "])
        if k == 11:
            return "<blockquote>" + self.block(depth + 1) + "</blockquote>"
        return self.words()

    def page(self):
        r = self.r
        body = "".join(self.block() for _ in range(r.randint(1, 7)))
        link = r.choice(['<a href="https://www.wikidata.org/wiki/Special:EntityPage/Q12">d</a>', "", '<a href="https://www.wikidata.org/wiki/Special:EntityPage/Q7/Q8">d</a>'])
        k = r.randint(0, 30)
        if k == 0:
            return f'<html><body><div class="a noarticletext">{body}</div>{link}</body></html>'
        if k == 1:
            return f'<html><body><div class="mw-parser-output">{body}</div>{link}</body></html>'
        return f'<!DOCTYPE html><html><body><div id="mw-content-text"><div class="x mw-parser-output">{body}</div></div>{link}</body></html>'


def test_random_pages_against_a_tree(spark):
    pages = [Pages(k).page() for k in range(N_PAGES)]
    df = spark.createDataFrame([(k, f"T{k}", "u", h) for k, h in enumerate(pages)], "input_seq long, page string, url string, text string")
    got = {r.input_seq: (r.status, r.qid if r.status == "ok" else None, r.text if r.status == "ok" else None) for r in C.cleaned_rows(df).collect()}
    wrong = []
    for k, page in enumerate(pages):
        status, qid, text = expected(page)
        want = (status, qid, text) if status == "ok" else (status, None, None)
        if got[k] != want:
            wrong.append((k, page, want, got[k]))
    assert not wrong, (len(wrong), *wrong[:2])
