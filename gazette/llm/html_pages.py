"""Labelled pages from which the content model learns: arrangements of page parts, each known to be main text or not."""

from __future__ import annotations

import random

#: Tag and class or id of containers of main text, and of other parts of a page.
MAIN = (
    ("article", ""), ("main", ""), ("article", "post"), ("div", "content"), ("div", "main-content"), ("div", "article-body"), ("div", "post-content"),
    ("div", "entry-content"), ("section", "story"), ("div", "story-body"), ("div", "text"), ("div", "main"), ("article", "entry"), ("div", "body-copy"), ("div", ""), ("section", "article"),
)
OTHER = (
    ("nav", ""), ("nav", "menu"), ("div", "navigation"), ("div", "navbar"), ("ul", "menu"), ("div", "breadcrumb"), ("header", ""), ("header", "site-header"), ("div", "header"),
    ("div", "masthead"), ("footer", ""), ("footer", "site-footer"), ("div", "footer"), ("div", "copyright"), ("aside", ""), ("aside", "sidebar"), ("div", "sidebar"),
    ("div", "widget"), ("div", "related"), ("section", "related-posts"), ("div", "recommended"), ("div", "ad"), ("div", "ads"), ("div", "advert"), ("div", "advertisement"),
    ("div", "banner"), ("div", "promo"), ("div", "sponsored"), ("ins", "adsbygoogle"), ("div", "cookie-notice"), ("div", "cookie-banner"), ("div", "notice"), ("div", "consent"), ("div", "alert"),
    ("div", "popup"), ("div", "modal"), ("div", "overlay"), ("form", ""), ("form", "search"), ("form", "newsletter"), ("div", "subscribe"), ("div", "newsletter-signup"),
    ("div", "login"), ("section", "comments"), ("div", "comments"), ("div", "comment-list"), ("ol", "commentlist"), ("div", "disqus_thread"), ("div", "replies"), ("div", "share"),
    ("div", "social"), ("div", "share-buttons"), ("div", "tags"), ("div", "pagination"), ("div", "pager"), ("div", "author-bio"), ("div", "toolbar"), ("div", "disclaimer"), ("div", "gdpr"), ("div", "skip-links"),
)
#: Words to fill the pages with. What they say does not matter; the model has no word features.
FILL = "morning report river council market price people city water road school team member plan work field house light paper number season group open large small first later north region".split()
#: Marks main text in a labelled page.
MARK = "data-main"


def _sentence(draw: random.Random, low: int, high: int) -> str:
    return " ".join(draw.choice(FILL) for _ in range(draw.randint(low, high))).capitalize() + "."


def _links(draw: random.Random, n: int) -> str:
    return "".join(f'<li><a href="/x">{draw.choice(FILL)} {draw.choice(FILL)}</a></li>' for _ in range(n))


def _other(draw: random.Random, part: tuple[str, str]) -> str:
    tag, name = part
    attr = f' {draw.choice(("class", "id"))}="{name}"' if name else ""
    kind = draw.randrange(4)
    if tag in ("nav", "ul") or "menu" in name:
        inside = _links(draw, draw.randint(3, 9))
        inside = inside if tag == "ul" else f"<ul>{inside}</ul>"
    elif tag == "form":
        inside = f"<label>{_sentence(draw, 2, 5)}</label><input name=q><button>{draw.choice(FILL)}</button>"
    elif "comment" in name or name in ("replies", "disqus_thread"):
        inside = "".join(f'<{t} class="comment"><p>{_sentence(draw, 5, 30)}</p></{t}>' for t in draw.choices(("div", "article", "li"), k=draw.randint(1, 4)))
        inside = f"<h3>{draw.randint(1, 9)} comments</h3>{inside}"
    elif tag == "header" or name in ("header", "masthead", "banner"):
        title = draw.choice(("h1", "h2", "div", "p"))
        inside = f"<{title}>{_sentence(draw, 1, 4)}</{title}>" + (f"<p>{_sentence(draw, 2, 8)}</p>" if kind else f"<ul>{_links(draw, 3)}</ul>")
    elif kind == 0:
        inside = f"<h3>{_sentence(draw, 1, 4)}</h3><ul>{_links(draw, draw.randint(2, 5))}</ul>"
    elif kind == 1:
        inside = f"<p>{_sentence(draw, 4, 25)}</p>"
    elif kind == 2:
        inside = _sentence(draw, 3, 20)
    else:
        inside = f'<span>{_sentence(draw, 2, 8)}</span> <a href="/y">{draw.choice(FILL)}</a>'
    return f"<{tag}{attr}>{inside}</{tag}>"


def _main(draw: random.Random, part: tuple[str, str]) -> str:
    tag, name = part
    attr = f' {draw.choice(("class", "id"))}="{name}"' if name else ""
    title = draw.choice(("h1", "h1", "h2"))
    heading = f"<{title}>{_sentence(draw, 1, 9)}</{title}>"
    if draw.random() < 0.3:
        heading = f"<header>{heading}{draw.choice(('', f'<p>{_sentence(draw, 2, 12)}</p>'))}</header>"
    blocks = [heading]
    for _ in range(draw.randint(1, 9)):
        kind = draw.random()
        if kind < 0.72:
            link = f' <a href="/z">{draw.choice(FILL)}</a> ' if draw.random() < 0.2 else " "
            blocks.append(f"<p>{_sentence(draw, 1, draw.choice((6, 20, 80)))}{link}<b>{draw.choice(FILL)}</b> {_sentence(draw, 1, 20)}</p>" if kind < 0.5 else f"<p>{_sentence(draw, 1, draw.choice((4, 30, 120)))}</p>")
        elif kind < 0.8:
            blocks.append("<ul>" + "".join(f"<li>{_sentence(draw, 2, 12)}</li>" for _ in range(draw.randint(2, 5))) + "</ul>")
        elif kind < 0.85:
            blocks.append(f"<blockquote><p>{_sentence(draw, 5, 25)}</p></blockquote>")
        elif kind < 0.9:
            blocks.append(f"<figure><img src=a.png><figcaption>{_sentence(draw, 3, 10)}</figcaption></figure>")
        elif kind < 0.95:
            blocks.append("<table>" + "".join(f"<tr><td>{draw.choice(FILL)}</td><td>{draw.randint(1, 99)}</td></tr>" for _ in range(3)) + "</table>")
        else:
            blocks.append(f"<h2>{_sentence(draw, 2, 6)}</h2>")
    if draw.random() < 0.4:  # a part that is not main text within it
        inner = [p for p in OTHER if p[0] not in ("nav", "header") and p[1] != "header"]
        blocks.insert(draw.randint(1, len(blocks)), _other(draw, draw.choice(inner)).replace(">", " data-other>", 1))
    return f"<{tag}{attr} {MARK}>{''.join(blocks)}</{tag}>"


def labelled_pages(n: int = 1_200, seed: int = 2) -> list[str]:
    """``n`` pages, always the same: a main part among others, at times in wrappers. Main text is under ``data-main``, but not under ``data-other``."""
    draw = random.Random(seed)
    pages = []
    for _ in range(n):
        before = [_other(draw, draw.choice(OTHER)) for _ in range(draw.randint(0, 4))]
        after = [_other(draw, draw.choice(OTHER)) for _ in range(draw.randint(0, 5))]
        main = _main(draw, draw.choice(MAIN))
        if draw.random() < 0.15:  # the heading stands before the container
            title = draw.choice(("h1", "h1", "h2"))
            main = f"<{title} {MARK}>{_sentence(draw, 1, 9)}</{title}>" + main
        kind = draw.random()
        if kind < 0.06:  # paragraphs straight in the body
            main = "".join(f"<{t} {MARK}>{_sentence(draw, 3, 60)}</{t}>" for t in (draw.choice(("h1", "h1", "h2")), *["p"] * draw.randint(1, 6)))
        elif kind < 0.1:  # a fragment of a page
            pages.append("".join(f"<p {MARK}>{_sentence(draw, 3, 60)}</p>" for _ in range(draw.randint(1, 6))))
            continue
        elif kind < 0.16:  # bare text in a container, with a part between
            inner = [p for p in OTHER if p[0] not in ("nav", "header") and p[1] != "header"]
            tag, name = draw.choice(MAIN)
            attr = f' class="{name}"' if name else ""
            part = _other(draw, draw.choice(inner)).replace(">", " data-other>", 1) if draw.random() < 0.7 else "<br>"
            title = draw.choice(("h1", "h2", "h3"))
            heading = f"<{title} {MARK}>{_sentence(draw, 1, 9)}</{title}>" if draw.random() < 0.7 else ""
            inside, outside = (heading, "") if draw.random() < 0.5 else ("", heading)
            main = f"{outside}<{tag}{attr} {MARK}>{inside}{_sentence(draw, 3, 60)}{part}{_sentence(draw, 3, 60)}</{tag}>"
        body = "".join(before) + main + "".join(after)
        if draw.random() < 0.4:
            body = f'<div {draw.choice(("class", "id"))}="{draw.choice(("wrapper", "container", "page", "site", "layout", "row"))}">{body}</div>'
        if draw.random() < 0.12:  # a form around the whole page is no form of it
            body = f"<form>{body}</form>"
        pages.append(f"<html><head><title>{_sentence(draw, 2, 6)}</title><script>x=1</script></head><body>{body}</body></html>")
    return pages
