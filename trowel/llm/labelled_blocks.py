"""The small labelled table of text blocks from which the extraction tree is trained.

Each page is a list of (label, piece of html); label 1: the text of the piece is main text.
Pieces that only open or close elements carry no text and no label.
"""

_PROSE = ("The river had risen over the lower fields by the time the first boats came down, and "
          "nobody in the village could say how long the bridge would hold.")
_SHORT = "It held for two days."
_LINKED = ('As <a href="/r">the report</a> shows, most of the older houses stand on ground that '
           "was raised by hand, long before any map of the valley was drawn.")
_OTHER = "Buy two pairs of boots and get the third one free until Sunday."

PAGES = [
    [(0, '<nav><ul><li><a href="/">Home</a></li>'), (0, '<li><a href="/n">News from here</a></li></ul></nav>'),
     (0, f'<div class="ad">{_OTHER}</div>'), (0, '<div class="ad">Sale now.</div>'),
     (1, "<article><h1>High water in the valley</h1>"), (1, f"<p>{_PROSE}</p>"), (1, f"<p>{_SHORT}</p>"),
     (1, f"<p>{_LINKED}</p>"), (1, "<p>No.</p></article>"),
     (0, "<footer>&copy; 2020 Valley Post. All rights reserved.</footer>")],
    [(0, '<header><div class="logo">Valley Post</div>'), (0, '<a href="/in">Sign in</a></header>'),
     (1, "<main><h1>On old maps</h1>"), (1, f"<p>{_LINKED}</p>"), (1, "<h2>What is left</h2>"),
     (1, f"<p>{_PROSE}</p>"), (1, "<ul><li>One map of the mill</li>"), (1, "<li>Two of the church</li></ul></main>"),
     (0, '<aside><h3>Most read</h3>'), (0, '<a href="/1">A winter without snow</a>'),
     (0, f"<p>{_OTHER}</p></aside>"), (0, '<footer><a href="/c">Contact</a></footer>')],
    [(0, '<div id="cookie-notice">We use cookies to make this page work. Accept all of them?</div>'),
     (1, '<div class="story"><h1>A bridge is rebuilt</h1>'), (1, f"<div>{_PROSE}</div>"),
     (1, f"<div>{_PROSE} {_LINKED}</div></div>"),
     (0, '<form action="/s"><label>Your name</label>'), (0, "<button>Send</button></form>"),
     (0, '<div class="comments"><h3>3 comments</h3>'), (0, f"<p>{_PROSE}</p>"),
     (0, "<p>I was there too.</p></div>"), (0, '<div class="footer">Imprint and terms</div>')],
    [(0, '<ul class="menu"><li><a href="/a">Start</a></li>'), (0, '<li><a href="/b">Shop</a></li></ul>'),
     (1, f"<p>{_PROSE}</p>"), (1, f"<p>{_LINKED}</p>"), (1, f"<p>{_PROSE}</p>"),
     (0, '<div class="related"><a href="/x">Ten more stories about rivers</a></div>'),
     (0, '<div class="share"><a href="/f">Share</a> <a href="/t">Send</a></div>')],
    [(0, "<article><nav><a href='/k'>Contents</a></nav>"), (1, "<header><h1>Of mills</h1></header>"),
     (1, f"<section><p>{_PROSE}</p></section>"), (1, f"<blockquote>{_SHORT}</blockquote>"),
     (1, "<table><tr><td>Mills</td>"), (1, "<td>14</td></tr></table>"),
     (0, "<aside>Read also: the salt road and its inns.</aside>"), (1, f"<p>{_PROSE}</p>"),
     (0, f'<div class="advert">{_OTHER}</div>'), (1, "<p>That is all.</p>"),
     (0, "<footer>Filed under water, mills</footer>"),
     (0, f'<section id="comments"><p>{_PROSE} Or so my father said.</p></section></article>')],
    [(0, f'<div class="sidebar"><p>{_OTHER}</p>'), (0, f"<p>{_PROSE}</p></div>"),
     (0, '<div role="alert">Our office is closed on Monday and opens again on Tuesday.</div>'),
     (1, f'<div class="post-body"><p>{_LINKED}</p>'), (1, f"<p>{_SHORT}</p>"), (1, f"<p>{_PROSE}</p></div>"),
     (0, '<p><a href="/p">Previous</a> <a href="/q">Next</a></p>'),
     (0, '<p><a href="/1">1</a> <a href="/2">2</a> <a href="/3">3</a></p>')],
    [(0, '<p><a href="/">Home</a> &gt; <a href="/v">Valley</a></p>'),
     (1, f"<div>{_PROSE}</div>"), (1, f"<div>{_PROSE}</div>"), (1, f"<div>{_LINKED}</div>"),
     (0, "<div>&copy; Valley Post</div>"), (0, '<div><a href="/i">Imprint</a></div>')],
    [(0, f"<div>{_OTHER}</div>"), (0, f"<p>{_PROSE}</p>"), (0, "<p>Open until six.</p>"),
     (1, "<article><h1>Where the salt road ran</h1>"), (1, "<p>See also</p>"),
     (1, '<p><a href="/s">The salt road, its inns and the people who kept them</a></p>'),
     (1, f"<p>{_PROSE}</p>"), (1, "<h2>Sources</h2>"), (1, '<ul><li><a href="/1">A map of 1640</a></li>'),
     (1, '<li><a href="/2">The tax rolls</a></li></ul>'),
     (0, '<div class="social"><a href="/f">Follow us</a></div></article>'),
     (0, f"<div><p>{_PROSE}</p>"), (0, f"<p>{_OTHER}</p></div>"), (0, '<p><a href="/n">Next</a></p>')],
    [(1, "<main><p>Closed.</p>"), (1, '<p><a href="/w">Why the mill closed</a></p>'), (1, f"<div>{_LINKED}</div>"),
     (0, '<div class="newsletter">Get one letter a week from us.</div></main>'),
     (0, f"<section>{_PROSE}</section>"), (0, "<p>Imprint</p>")],
    [(0, f"<nav><p>{_PROSE}</p></nav>"), (0, f'<div class="banner">{_PROSE}</div>'), (1, f"<p>{_PROSE}</p>"),
     (1, f"<p>{_LINKED}</p>"), (0, f"<aside>{_PROSE}</aside>"), (0, f"<form><p>{_LINKED}</p></form>"),
     (0, f"<footer><p>{_PROSE}</p></footer>")],
    [(0, f"<header><p>{_PROSE}</p></header>"), (0, f'<div id="sidebar">{_LINKED}</div>'), (1, f"<div>{_PROSE}</div>")],
    # wrappers whose names speak of what they hold besides the text, or of what they do not
    [(1, '<div class="has-sidebar"><h1>On the salt road</h1>'), (1, f"<p>{_PROSE}</p>"), (1, f"<p>{_SHORT}</p>"),
     (1, f"<p>{_LINKED}</p>"), (0, f'<div class="sidebar"><p>{_OTHER}</p></div></div>'),
     (0, "<footer>Imprint and terms</footer>")],
    [(0, '<nav><a href="/">Home</a></nav>'), (1, f'<main class="no-sidebar"><p>{_PROSE}</p>'), (1, f"<p>{_LINKED}</p></main>"),
     (0, f"<footer><p>{_OTHER}</p></footer>")],
    [(0, f"<header><p>{_OTHER}</p></header>"), (1, f'<div class="single-post comments-open"><p>{_PROSE}</p>'),
     (1, f"<p>{_PROSE}</p>"), (1, "<p>No.</p>"), (0, f'<div class="comments"><p>{_PROSE}</p>'),
     (0, "<p>So I heard.</p></div></div>")],
    [(0, '<nav><a href="/">Home</a></nav>'), (1, f'<div class="layout-sidebar"><p>{_PROSE}</p>'), (1, f"<p>{_LINKED}</p></div>"),
     (0, f"<aside><p>{_PROSE}</p>"), (0, f"<p>{_OTHER}</p></aside>")],
    # more words beside the text than in it
    [(0, f'<div class="sidebar"><p>{_PROSE}</p></div>'), (1, f"<p>{_PROSE}</p>"), (1, f"<p>{_SHORT}</p>")],
    [(1, "<main><p>Closed.</p>"), (0, f'<div class="comments"><p>{_PROSE}</p>'), (0, "<p>So I heard.</p></div></main>")],
    [(1, f"<div><p>{_PROSE}</p>"), (1, f"<p>{_LINKED}</p></div>"), (0, f'<div class="comments"><p>{_PROSE}</p>'),
     (0, f"<p>{_PROSE}</p>"), (0, f"<p>{_LINKED}</p></div>")],
    # the page in a form, as some servers write it
    [(0, f'<form id="aspnet"><nav><a href="/">Home</a></nav>'), (1, f"<article><h1>On the salt road</h1><p>{_PROSE}</p>"),
     (1, f"<p>{_LINKED}</p></article>"), (0, f"<footer>{_OTHER}</footer></form>")],
    [(0, '<form action="/"><div class="menu"><a href="/">Home</a></div>'), (1, f"<div><p>{_PROSE}</p>"), (1, f"<p>{_LINKED}</p>"),
     (1, f"<p>{_PROSE}</p></div>"), (0, "<label>Your name</label></form>")],
    # a list of links in the middle of a text, and lists before and after it
    [(0, '<ul><li><a href="/a">Start</a></li>'), (0, '<li><a href="/b">Shop</a></li></ul>'), (1, f"<p>{_PROSE}</p>"),
     (1, '<ul><li><a href="/1">A map of 1640</a></li>'), (1, '<li><a href="/2">The tax rolls</a></li>'),
     (1, '<li><a href="/3">Letters</a></li></ul>'), (1, f"<p>{_PROSE}</p>"), (0, '<ul><li><a href="/x">More</a></li>'),
     (0, '<li><a href="/y">All of them</a></li></ul>')],
    [(0, '<div><a href="/1">A winter without snow in the upper valley</a>'), (0, '<p><a href="/2">Who owns the old mill now?</a></p></div>'),
     (1, f"<div><p>{_PROSE}</p>"), (1, '<ul><li><a href="/3">How the salt road was paid for and by whom</a></li>'),
     (1, '<li><a href="/4">Two</a></li></ul>'), (1, f"<p>{_PROSE}</p></div>"),
     (0, '<ul><li><a href="/5">Ten more stories about rivers and the people there</a></li>'),
     (0, '<li><a href="/6">What the tax rolls tell</a></li></ul>')],
    # short lines at the end of an article
    [(1, f"<article><p>{_PROSE}</p>"), (1, "<p>So it went.</p></article>")],
    [(1, f"<main><p>{_LINKED}</p>"), (1, "<p>That was it.</p></main>"), (0, '<p><a href="/">Home</a></p>')],
    [(1, "<article><p>In short: no.</p>"), (1, "<p>It held on.</p></article>")],
    # names of parts beside the text without an element of their own
    [(0, f'<div class="header">{_OTHER}</div>'), (0, f'<div class="adslot">{_PROSE}</div>'), (1, f"<div>{_PROSE}</div>"),
     (1, f"<div>{_LINKED}</div>"), (0, f'<div class="site-footer">{_OTHER}</div>')],
]
