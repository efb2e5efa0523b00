"""Main text of web pages by consensus host paths.

First pass: each page's containers are scored by the running text below them
and the page votes for its best one by generalised path (tags and classes from
the root, digits dropped).  Spark counts the votes of each (host, path) and
picks each host's winner.  Second pass: every page is extracted from the
elements on its host's winning path; a page without such an element falls back
to its own best container.  Inside the container menus, forms, adverts, notices
and the like are left out.  Tags and roles such as nav or aside settle that;
class and id words and forms are a hint only, which a container that holds the
page's main text outweighs (decided once the page is read).

Votes are partial aggregations, so a host with a third of all pages costs one
row per task and path.  The winners are written to the shared folder; up to
``BROADCAST_HOSTS`` of them are broadcast, more are left to the planner's join.

Text: character references are decoded, white space (``<br>`` too) becomes one
blank, blocks are trimmed, empty ones dropped, and joined in page order by two
line ends.  Defined results: null or empty html gives an empty text; a null or
malformed url has the empty host, whose pages vote together; a page without a
body or tags is one text; repeated pages get equal texts; further columns are
carried through.  All steps are linear in the page.
"""

from __future__ import annotations

import hashlib
import html as entities
import re
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tsforge.llm.common import fresh, written

#: Hosts whose winners are broadcast (some 100 bytes each).
BROADCAST_HOSTS = 200_000
#: Hosts that vote by page; a path needs no quorum: the most votes win, then the higher score, then the key.

# Fixed word lists.
BLOCKS = frozenset("""address article aside blockquote body caption center dd details dialog dir div dl dt fieldset
figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol
optgroup option p pre section summary table tbody td tfoot th thead title tr ul""".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp noembed noframes iframe".split())
LEAVES = frozenset("p h1 h2 h3 h4 h5 h6 li pre blockquote dd dt td th tr tbody figcaption figure".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
DROPPED_TAGS = frozenset("""head nav aside footer form script style noscript template iframe object svg canvas audio
video select button textarea input menu dialog fieldset option""".split())
DROPPED_ROLES = frozenset("navigation banner contentinfo search complementary alert dialog menu menubar form".split())
DROPPED_WORDS = frozenset("""nav navbar navigation menu sidebar footer masthead ad ads adv advert adverts advertisement
advertising sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices alert newsletter
subscribe subscription signup login share sharing social related recommended recommendations comment comments
commentlist respond reply replies discussion disqus breadcrumb breadcrumbs pagination pager popup modal toolbar widget
widgets skip copyright disclaimer teaser trending tags hidden""".split())
#: Of the tags and roles above those that may also lie around a whole page.
HINT_TAGS, HINT_ROLES = frozenset(("form", "fieldset")), frozenset(("form",))
CONTENT_WORDS = frozenset("article content post entry story main body text page blog".split())
CLOSED_BY = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
             "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}),
             "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"})}

# at most 600 pieces between quotes in a tag, so that unbalanced quotes don't cost a scan of the page each;
# a longer tag, or one with unbalanced quotes, ends at its bracket before the next "<"
_TOKEN = re.compile(r"<!--.*?(?:--!?>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+'){0,600}+)>|<[!?][^>]*>"
                    r"|<(/?)([a-zA-Z][^\s/<>\"']*)((?:[^<>\"']++|\"[^\"<]*+\"|'[^'<]*+'|[\"'])*+)>", re.S)
_ATTR = re.compile(r"([a-zA-Z_:][-\w:.]*)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|$)|aria-hidden\s*=\s*[\"']?true|display\s*:\s*none|visibility\s*:\s*hidden", re.I)


class Page:
    """Block elements and text blocks of one page.

    Element k has tag[k], parent[k], key[k] (8 bytes that stand for its
    generalised path), step[k] (its own part of the path), gone[k] (it is never
    main text by its tag, role or attributes), hinted[k] (by its words, or a
    form), dropped[k] (in or below something that is never main text)."""

    def __init__(self, source: str):
        self.tag, self.parent, self.key, self.step = ["#"], [-1], [b""], [""]
        self.gone, self.hinted, self.is_main, self.plus = [False], [False], [False], [1.0]
        self.in_article, self.in_header = [False], [False]
        self.blocks: list[tuple[int, str, int]] = []  # element, text, characters in links
        self._read(source)
        self.dropped = self._drops()

    def _open(self, tag: str, attrs: str, parent: int) -> int:
        words: set[str] = set()
        classes = role = ""
        gone, hinted = tag in DROPPED_TAGS and tag not in HINT_TAGS, tag in HINT_TAGS
        if attrs and not attrs.isspace():
            for m in _ATTR.finditer(attrs):
                name, value = m[1].lower(), m[2] or m[3] or m[4] or ""
                if name in ("class", "id"):
                    words.update(w.lower() for w in _WORD.findall(value))
                    if name == "class":
                        classes = ".".join(sorted({re.sub(r"\d+", "", c) for c in value.lower().split()}))
                elif name == "role":
                    role = value.lower()
            gone = gone or bool(_HIDDEN.search(attrs)) or (role in DROPPED_ROLES and role not in HINT_ROLES)
            hinted = hinted or role in HINT_ROLES
        if tag not in ("html", "body", "article", "main"):
            hinted = hinted or not words.isdisjoint(DROPPED_WORDS)
        elif "comment" in words or "comments" in words:
            gone = gone or tag == "article"
        if tag == "header":  # of the page; one in an article keeps its headings
            gone = gone or not self.in_article[parent]
        step = f"{tag}.{classes}" if classes else tag
        self.tag.append(tag), self.parent.append(parent), self.step.append(step)
        self.key.append(hashlib.blake2b(self.key[parent] + step.encode("utf-8", "replace"), digest_size=8).digest())
        self.in_article.append(self.in_article[parent] or tag in ("article", "main"))
        self.in_header.append(self.in_header[parent] or tag == "header")
        self.gone.append(gone), self.hinted.append(hinted), self.is_main.append(tag == "main" or role == "main")
        good = tag in ("article", "main") or role in ("main", "article")
        self.plus.append(1.5 if good else 1.25 if not words.isdisjoint(CONTENT_WORDS) else 0.6 if tag == "body" else 1.0)
        return len(self.tag) - 1

    def _drops(self) -> list[bool]:
        """dropped[k].  A hinted element stays if it holds

        * a main element, or the page's longest article, that being longer than
          all running text outside hinted elements, or
        * most of the running text, with an h1 (unless the page has none) or
          with no running text outside hinted elements.

        A page that has no text left is taken without the hints."""
        n = len(self.tag)
        structural = list(self.gone)
        for k in range(1, n):  # parents come before their children
            structural[k] = structural[k] or structural[self.parent[k]]
        if not any(self.hinted):
            return structural
        near = [k if self.hinted[k] else 0 for k in range(n)]  # the next hinted element upwards
        for k in range(1, n):
            near[k] = near[k] or near[self.parent[k]]
        running, region, articles, h1, main = [0] * n, [0] * n, [0] * n, [False] * n, [False] * n
        for k, text, linked in self.blocks:
            if structural[k]:
                continue
            h1[k] = h1[k] or self.tag[k] == "h1"
            if self.tag[k] not in HEADINGS:
                running[k] += len(text) - linked
                region[near[k]] += len(text) - linked
        for k in range(n - 1, 0, -1):
            up = self.parent[k]
            if not structural[k]:
                if self.tag[k] == "article":
                    articles[k] = max(articles[k], running[k])
                running[up] += running[k]
                articles[up] = max(articles[up], articles[k])
                h1[up] = h1[up] or h1[k]
                main[up] = main[up] or main[k] or self.is_main[k]
        dropped, outside = [False] * n, region[0]
        for k in range(1, n):
            dropped[k] = structural[k] or dropped[self.parent[k]]
            if self.hinted[k] and not dropped[k]:
                stays = (main[k] or (articles[k] == articles[0] and articles[k] > outside)
                         or (2 * running[k] > running[0] and (h1[k] or not h1[0] or not outside)))
                dropped[k] = not stays
                if stays:
                    outside += region[k]
        return structural if all(dropped[k] for k, _, _ in self.blocks) else dropped

    def _read(self, source: str) -> None:
        stack, have, buffer, linked, link, at = [0], {}, [], 0, 0, 0

        def flush() -> None:
            nonlocal linked
            if buffer:
                text = " ".join("".join(buffer).split())
                if text:
                    self.blocks.append((stack[-1], text, min(linked, len(text))))
                buffer.clear()
            linked = 0

        def pop_to(tags: set[str], stop: set[str]) -> None:
            for d in range(len(stack) - 1, 0, -1):
                t = self.tag[stack[d]]
                if t in stop:
                    return
                if t in tags:
                    for k in stack[d:]:
                        have[self.tag[k]] -= 1
                    del stack[d:]
                    return

        while True:
            m = _TOKEN.search(source, at)
            chunk = source[at : m.start() if m else len(source)]
            if chunk:
                text = entities.unescape(chunk) if "&" in chunk else chunk
                buffer.append(text)
                if link:
                    linked += len(text)
            if not m:
                break
            at = m.end()
            slash, name, attrs = m.group(1, 2, 3) if m[2] else m.group(4, 5, 6)
            if name is None:
                continue
            tag, closing = name.lower(), bool(slash)
            if tag == "br":
                buffer.append(" ")
            elif tag == "a":
                link = 0 if closing else 1
            elif closing:
                if tag in BLOCKS or have.get(tag):
                    flush()
                    if have.get(tag):
                        pop_to({tag}, set())
                    link = 0
            elif tag in RAW:
                end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])", re.I).search(source, at)
                at = source.find(">", end.end()) + 1 if end else len(source)
                at = at or len(source)
            elif tag in BLOCKS or tag in DROPPED_TAGS:
                flush()
                if tag in BLOCKS and have.get("p"):
                    pop_to({"p"}, {"td", "th", "div", "article", "section", "li", "table"})
                if tag in CLOSED_BY:
                    pop_to(*CLOSED_BY[tag])
                if tag not in VOID and not attrs.endswith("/"):
                    stack.append(self._open(tag, attrs, stack[-1]))
                    have[tag] = have.get(tag, 0) + 1
        flush()

    def best(self) -> tuple[int, float]:
        """The container with the most running text (0: the page itself) and its score."""
        score: dict[int, float] = {}
        for k, text, linked in self.blocks:
            if self.dropped[k] or self.tag[k] in HEADINGS:
                continue
            n = len(text)
            s = (min(n / 25, 1) + text.count(",") + min(n / 100, 3)) * (1 - linked / n)
            c, share = k, 1.0
            while self.tag[c] in LEAVES:
                c = self.parent[c]
            for _ in range(3):
                if c <= 0 or self.tag[c] == "html":
                    break
                score[c] = score.get(c, 0.0) + s * share * self.plus[c]
                c, share = self.parent[c], share / 2
        if not score:
            return 0, 0.0
        top = min(score, key=lambda c: (-score[c], c))
        return top, score[top]

    def path(self, k: int) -> str:
        steps = []
        while k > 0:
            steps.append(self.step[k])
            k = self.parent[k]
        return "/".join(reversed(steps))

    def text(self, winner: bytes | None) -> str:
        """From the elements whose path is ``winner``, else from the best container."""
        n = len(self.tag)
        chosen = [False] * n
        hit = [k for k in range(1, n) if winner and self.key[k] == winner and not self.dropped[k]]
        for k in hit or [self.best()[0]]:
            chosen[k] = True
        for k in range(1, n):  # parents come before their children
            chosen[k] = chosen[k] or chosen[self.parent[k]]
        out = []
        for k, text, _ in self.blocks:
            if chosen[k] and not self.dropped[k]:
                if self.tag[k] not in HEADINGS and self.in_header[k]:
                    continue
                out.append(text)
        return "\n\n".join(out)


def host_of(url):
    """The lower-case host of a url column (null, malformed: empty)."""
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)), F.lit(""))


def votes(pages: DataFrame, html_col: str = "html", url_col: str = "url") -> DataFrame:
    """(host, key, path, votes, score): the containers that pages of a host chose."""
    def work(batches: Iterator) -> Iterator:
        import pyarrow as pa

        schema = pa.schema([("host", pa.string()), ("key", pa.binary()), ("path", pa.string()), ("votes", pa.int64()),
                            ("score", pa.float64())])
        for b in batches:
            seen: dict[tuple[str, bytes], list] = {}
            for host, source in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                page = Page(source or "")
                k, s = page.best()
                if k:
                    got = seen.setdefault((host, page.key[k]), [page.path(k)[:400], 0, 0.0])
                    got[1] += 1
                    got[2] += min(s, 100.0)
            yield pa.RecordBatch.from_pylist([{"host": h, "key": k, "path": p, "votes": n, "score": s}
                                              for (h, k), (p, n, s) in seen.items()], schema=schema)

    rows = pages.select(host_of(F.col(url_col)).alias("host"), F.col(html_col).alias("html")).mapInArrow(
        work, "host string, key binary, path string, votes long, score double")
    # scores are rounded: their sum must not hang on the order of the rows
    return rows.groupBy("host", "key").agg(F.min("path").alias("path"), F.sum("votes").alias("votes"),
                                           F.sum(F.round(F.col("score") * 16).cast("long")).alias("score"))


def host_paths(pages: DataFrame, html_col: str = "html", url_col: str = "url") -> DataFrame:
    """(host, key, path, votes) of each host's winning path."""
    found = votes(pages, html_col, url_col)
    return found.groupBy("host").agg(F.max(F.struct("votes", "score", "key", "path")).alias("w")).select(
        "host", "w.key", "w.path", "w.votes")


def extract(pages: DataFrame, html_col: str = "html", url_col: str = "url",
            broadcast_hosts: int = BROADCAST_HOSTS) -> DataFrame:
    """``pages`` with ``text`` (main text) and ``host_path`` (the path that its host agreed on)."""
    out, path, host, key, h = fresh(pages.columns, "text", "host_path", "_host", "_key", "_h")
    winners = written(host_paths(pages, html_col, url_col), "host-paths").select(
        F.col("host").alias(h), F.col("key").alias(key), F.col("path").alias(path))
    if winners.count() <= broadcast_hosts:
        winners = F.broadcast(winners)
    rows = pages.withColumn(host, host_of(F.col(url_col)))
    rows = rows.join(winners, rows[host] == winners[h], "left").drop(host, h)

    def work(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for b in batches:
            texts = [Page(s).text(k) if s else "" for s, k in
                     zip(b.column(html_col).to_pylist(), b.column(key).to_pylist())]
            cols = {n: c for n, c in zip(b.schema.names, b.columns) if n != key} | {out: pa.array(texts, pa.string())}
            yield pa.RecordBatch.from_arrays(list(cols.values()), names=list(cols))

    schema = T.StructType([*rows.drop(key).schema.fields]).add(out, "string")
    return rows.mapInArrow(work, schema)
