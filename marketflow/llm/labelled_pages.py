"""Labelled pages to train the extraction on: layouts in common use, elements marked main or other.

The words are filler; what matters is the structure, the names and the lengths.
"""

from __future__ import annotations

_FILL = (
    "The river rose through the night and by morning the lower fields were under water. Nobody in the village "
    "could say when it had last come so far, though the miller kept a notch on the door post. They moved the "
    "animals first, then the stores, and last of all the books from the school, carried in a chain of hands."
)


def _text(at: int, words: int) -> str:
    found = _FILL.split()
    return " ".join(found[(at + k) % len(found)] for k in range(words))


def _paragraphs(*sizes: int) -> str:
    return "".join(f"<p>{_text(7 * k, n)}</p>" for k, n in enumerate(sizes))


def _links(*names: str, each: str = "li") -> str:
    return "".join(f'<{each}><a href="/{n}">{n}</a></{each}>' for n in names)


def _comments(count: int, words: int, css: str = "comment") -> str:
    return "".join(f'<div class="{css}"><b>reader{k}</b><p>{_text(3 * k, words)}</p></div>' for k in range(count))


_NAV = f"<nav><ul>{_links('Home', 'News', 'Sport', 'About')}</ul></nav>"
_FOOT = "<footer><p>&copy; 2024 Example Press. All rights reserved.</p></footer>"


def labelled_pages() -> list[str]:
    """The pages; an element without a mark has its parent's."""
    main, other = 'data-label="main"', 'data-label="other"'
    pages = []
    for longer in (1, 3):
        body = _paragraphs(*[30 * longer, 55 * longer, 12, 41 * longer])
        pages += [
            f"<body>{_NAV}<div class='ad'>{_text(0, 12)}</div><article {main}><h1>Floods again</h1>{body}</article>{_FOOT}</body>",
            f"<body><header><h1>Example Press</h1>{_NAV}</header><main {main}><h2>Floods again</h2>{body}"
            f"<aside {other}><h3>Related</h3><ul>{_links('One story', 'Another story', 'A third')}</ul></aside></main>{_FOOT}</body>",
            f"<body><div id='header'><a href='/'>Press</a></div><div id='nav'>{_links('a', 'b', 'c', each='span')}</div>"
            f"<div id='content' {main}><h1>Floods</h1>{body}</div><div id='sidebar'><h4>Popular</h4><ul>{_links('x', 'y', 'z')}</ul>"
            f"<p>{_text(4, 20)}</p></div><div id='footer'><p>{_text(1, 15)}</p></div></body>",
            f"<body><div class='cookie-notice'><p>We use cookies to improve the site, {_text(2, 25)}.</p><button>Accept</button></div>{_NAV}"
            f"<article {main}><h1>Floods</h1>{body}<section class='comments' {other}><h3>Comments</h3>{_comments(4, 30)}</section>"
            f"<form {other}><label>Name</label><textarea>say</textarea><button>Send</button></form></article>{_FOOT}</body>",
            f"<body><article {main}><header><h1>Floods</h1><p>By A. Writer</p></header><div class='entry-content'>{body}"
            f"<blockquote><p>{_text(9, 22)}</p></blockquote><ul><li>{_text(3, 9)}</li><li>{_text(5, 11)}</li></ul></div>"
            f"<div class='share' {other}>{_links('Mail', 'Print', each='span')}</div>"
            f"<footer {other}><p>Filed under <a href='/t'>weather</a></p></footer></article><div id='comments'>{_comments(3, 40)}</div></body>",
            f"<body><div class='wrap'><div class='banner'><p>{_text(6, 14)}</p></div><div class='main'><div class='post' {main}>"
            f"<h1>Floods</h1>{body}<div class='advert' {other}><p>{_text(8, 16)}</p><a href='/buy'>Buy now</a></div>{_paragraphs(35 * longer)}"
            f"</div></div><div class='newsletter'><form><p>{_text(2, 18)}</p><input><button>Subscribe</button></form></div></div>{_FOOT}</body>",
            f"<body><section><h2>Floods</h2><div {main}>{body}<table><tr><td>Level</td><td>{_text(1, 4)}</td></tr></table><pre>{_text(0, 18)}</pre>"
            f"</div></section><aside><p>{_text(5, 40)}</p><ul>{_links('m', 'n')}</ul></aside><section class='comment-list'><ol>"
            f"<li>{_text(7, 33)}</li><li>{_text(1, 25)}</li></ol></section></body>",
            f"<body><div role='banner'><p>{_text(3, 10)}</p></div><div role='navigation'>{_links('q', 'r')}</div><div role='main' {main}>"
            f"<h1>Floods</h1><p>{_text(0, 25 * longer)} <a href='/x'>{_text(2, 3)}</a> <em>{_text(4, 6)}</em></p>{body}</div>"
            f"<div class='modal popup'><p>{_text(4, 24)}</p></div><div role='contentinfo'><p>{_text(1, 12)}</p></div></body>",
            f"<body><div class='menu'><ul>{_links('u', 'v', 'w')}</ul></div><div {main}><h1>Floods</h1>{body}</div>"
            f"<div class='related'><h3>More</h3><p><a href='/1'>{_text(1, 7)}</a></p><p><a href='/2'>{_text(3, 8)}</a></p></div>"
            f"<div class='sponsored'><p>{_text(6, 30)}</p></div></body>",
            f"<body><div class='sidebar'><article><h3>Teaser</h3><p>{_text(5, 9)}</p></article><article><p>{_text(2, 12)}</p></article></div>"
            f"<div class='article-body' {main}><h1>Floods</h1>{body}<form class='signup' {other}><p>{_text(1, 9)}</p><input><button>Go</button></form>"
            f"<ul class='social' {other}>{_links('Share', 'Post')}</ul></div></body>",
            f"<body>{_NAV}<article {main}><h1>Floods</h1><form {other}><p>{_text(8, 14)}</p><label>Mail</label><input><button>Send</button></form>{body}"
            f"<aside {other}><p>{_text(3, 26)}</p></aside><div class='comments' {other}>{_comments(2, 50)}</div></article>"
            f"<form><p>{_text(6, 20)}</p><fieldset><legend>Poll</legend><p>{_text(0, 8)}</p></fieldset></form>{_FOOT}</body>",
            f"<body><div class='topbar'><p>{_text(0, 8)}</p></div><div class='story-text' {main}>{body}<nav {other}>{_links('Next', 'Back')}</nav></div>"
            f"<div class='notice'><p>{_text(4, 30)}</p></div><div class='copyright'><p>{_text(2, 16)}</p></div></body>",
            f"<body>{_NAV}<h1 {main}>Floods</h1>{body.replace('<p>', f'<p {main}>')}<p class='copyright'>{_text(3, 9)}</p>{_FOOT}</body>",
            f"<body><h1 {main}>Floods</h1>{body.replace('<p>', f'<p {main}>')}</body>",
            f"<body><table class='layout'><tr><td class='menu'><ul>{_links('a', 'b')}</ul></td><td class='content' {main}>{body}</td></tr></table></body>",
        ]
    # Short articles, and boilerplate longer than the article.
    pages += [
        f"<body>{_NAV}<article {main}><h1>Short</h1><p>{_text(2, 6)}</p></article>{_FOOT}</body>",
        f"<body>{_NAV}<article {main}><p>{_text(2, 2)}</p></article><aside><p>{_text(2, 60)}</p></aside><footer><p>{_text(4, 50)}</p></footer></body>",
        f"<body><nav><p>{_text(4, 40)}</p></nav><main {main}><p>{_text(0, 4)}</p><p>{_text(5, 3)}</p></main><div class='comments'>{_comments(6, 45)}</div></body>",
        f"<body>{_NAV}<div class='ad'>{_text(1, 45)}</div>{_FOOT}</body>",
    ]
    return pages
