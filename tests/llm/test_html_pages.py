"""Extraction on pages written by hand in the manner of common sites, each block labelled by hand."""

from quillstone.llm import html_crf

# (html, the blocks of the main text in page order)
PAGES = [
    (  # a newspaper: semantic tags, a byline, a pull quote, an advert inside the article, reader comments
        """<!doctype html><html lang=en><head><meta charset=utf-8><title>Bridge to close for repairs | The Valley Post</title>
        <script>window.dataLayer=window.dataLayer||[];for(var i=0;i<n;i++){if(a<b&&c>d)push("</p>")}</script><style>.x>p{margin:0 auto}</style></head>
        <body class="page-article"><a class="skip-link" href="#c">Skip to content</a>
        <header class="site-header"><div class="logo"><a href="/">The Valley Post</a></div><nav class="main-nav"><ul><li><a href="/news">News</a><li><a href="/sport">Sport</a><li><a href="/weather">Weather</a></ul></nav></header>
        <div class="cookie-banner"><p>We use cookies to improve your experience. Read our <a href="/privacy">privacy policy</a>.</p><button>Accept all</button></div>
        <main><article class="story"><h1>Old bridge to close for six weeks of repairs</h1>
        <p>The stone bridge over the Arden will close to all traffic on Monday, the county council said on Thursday.</p>
        <p>Engineers found cracks in two of its five arches last autumn. &ldquo;It is safe today, but it will not stay safe,&rdquo; said the council&#39;s chief engineer.</p>
        <div class="ad-slot"><p>Advertisement</p><p>Save up to 40 % on garden furniture this weekend only.</p></div>
        <h2>What drivers should expect</h2>
        <p>Buses will run by way of <a href="/maps">the new road</a>, which adds about twelve minutes. Cyclists and walkers may use a temporary foot&shy;bridge.</p>
        <blockquote><p>We waited thirty years for this.</p></blockquote>
        <ul><li>Closed: from Monday, 6 a.m.</li><li>Diversion: by the ring road</li></ul>
        <p>The work is to cost 2.4 million and to end before the summer fair.</p></article>
        <section id="comments" class="comments"><h2>Comments (2)</h2><div class="comment"><p>About time too, I have driven over it for years.</p></div><div class="comment"><p>Twelve minutes? More like forty.</p></div></section></main>
        <aside class="sidebar"><h3>Most read</h3><ul><li><a href="/1">Fire at the mill</a></li><li><a href="/2">School wins prize</a></li></ul></aside>
        <footer class="site-footer"><p>&copy; 2024 The Valley Post Ltd. All rights reserved.</p><ul><li><a href="/about">About</a></li><li><a href="/contact">Contact</a></li></ul></footer></body></html>""",
        ["Old bridge to close for six weeks of repairs", "The stone bridge over the Arden will close to all traffic on Monday, the county council said on Thursday.",
         "Engineers found cracks in two of its five arches last autumn. “It is safe today, but it will not stay safe,” said the council's chief engineer.", "What drivers should expect",
         "Buses will run by way of the new road, which adds about twelve minutes. Cyclists and walkers may use a temporary foot\xadbridge.", "We waited thirty years for this.", "Closed: from Monday, 6 a.m.", "Diversion: by the ring road",
         "The work is to cost 2.4 million and to end before the summer fair."],
    ),
    (  # a blog in named divisions, upper-case tags, unclosed paragraphs
        """<HTML><HEAD><TITLE>Sourdough, day three</TITLE></HEAD><BODY><DIV ID=wrapper><DIV ID=header><H1><A HREF=/>Crumbs and Co</A></H1><P>A blog about bread</P></DIV>
        <DIV ID=menu><UL><LI><A HREF=/a>Home<LI></A><LI><A HREF=/b>Recipes</A><LI><A HREF=/c>Shop</A></UL></DIV>
        <DIV CLASS="post hentry"><H2>Sourdough, day three</H2><DIV CLASS=entry-content>
        <P>On the third day the starter smells of apples.<BR>That is how it should be.
        <P>Feed it with 50 g of flour and 50 g of water, stir, and wait.
        <P>Patience is a long-for<WBR>gotten virtue in my kitchen.
        <OL><LI>Weigh the flour.<LI>Add the water at 27 &deg;C.<LI>Stir until smooth.</OL>
        <P>Tomorrow we bake!</DIV></DIV>
        <DIV CLASS=sharedaddy><SPAN>Share this:</SPAN><A HREF=#>Mail</A> <A HREF=#>Print</A></DIV>
        <OL CLASS=commentlist><LI CLASS=comment><P>Mine smells of cheese, is that bad?</P></LI><LI CLASS="comment reply"><P>Give it one more day.</P></LI></OL>
        <FORM ID=respond><LABEL>Leave a reply</LABEL><TEXTAREA>your < words</TEXTAREA><P>Your address will not be published.</P></FORM>
        <DIV ID=sidebar><H3>Archives</H3><UL><LI><A HREF=/m>May</A><LI><A HREF=/n>June</A></UL></DIV><DIV ID=footer><P>Powered by flour. Copyright 2011.</P></DIV></DIV></BODY></HTML>""",
        ["Sourdough, day three", "On the third day the starter smells of apples. That is how it should be.", "Feed it with 50 g of flour and 50 g of water, stir, and wait.", "Patience is a long-forgotten virtue in my kitchen.",
         "Weigh the flour.", "Add the water at 27 °C.", "Stir until smooth.", "Tomorrow we bake!"],
    ),
    (  # software documentation: code, a table, a table of contents beside it
        """<html><body><div class="navbar"><a href="/">tool docs</a> <a href="/api">API</a> <a href="/faq">FAQ</a></div><div class="container"><nav class="toc sidebar"><ul><li><a href="#i">Install</a></li><li><a href="#u">Use</a></li></ul></nav>
        <main role="main"><h1>Getting started</h1><p>This page shows how to install the tool and to run it once.</p><h2 id=i>Install</h2><pre><code>get tool
        tool --version</code></pre><p>If <code>a &lt; b</code> the run stops; see <a href="/faq">the questions</a>.</p><h2 id=u>Use</h2>
        <table><thead><tr><th>Flag</th><th>Meaning</th></tr></thead><tbody><tr><td>-v</td><td>say more</td></tr><tr><td>-q</td><td>say nothing</td></tr></tbody></table>
        <p>That is all you need for a first run.</p></main></div><div class="pagination"><a href="/p">Previous</a> <a href="/n">Next</a></div><footer>Built with care. Last updated in May.</footer>
        <script type="text/javascript">document.write('<p>tracked</p>'); for(;x<y;){}</script></body></html>""",
        ["Getting started", "This page shows how to install the tool and to run it once.", "Install", "get tool tool --version", "If a < b the run stops; see the questions.", "Use", "Flag", "Meaning", "-v", "say more", "-q", "say nothing", "That is all you need for a first run."],
    ),
    (  # a plain page of the nineties: a layout table, no names to go by but the menu's
        """<html><head><title>My trip</title></head><body bgcolor=white><table width=100%><tr><td width=120 class=menu><a href=i.html>Home</a><br><a href=p.html>Pictures</a><br><a href=g.html>Guest book</a>
        <td class=content><h1>My trip to the north</h1><p>We left on a Tuesday, in the rain, with two bags and no map.<p>By noon we had reached the coast, and the rain had turned to hail.<p>It's the dog's favourite road, said my sister.</table>
        <div class=footer><hr><p>This site was made with a text editor. &copy; me</div></body></html>""",
        ["My trip to the north", "We left on a Tuesday, in the rain, with two bags and no map.", "By noon we had reached the coast, and the rain had turned to hail.", "It's the dog's favourite road, said my sister."],
    ),
    (  # a magazine with an unquoted apostrophe in an attribute, a newsletter box and related stories inside the article
        """<body><header><p>Field Notes</p></header><article><h1>How owls hear</h1><p>An owl&rsquo;s ears do not sit level. <a title=Owl's href=/x>One</a> is higher than the other, and it's this that tells it how high a mouse stands.</p>
        <aside class="related"><h4>Read next</h4><ul><li><a href="/bats">How bats hear</a></li></ul></aside>
        <p>The face is a dish. Feathers round its rim send the sound inward; a <em>barn owl</em> can strike in full darkness.</p>
        <figure><img src=o.jpg><figcaption>A barn owl in flight.</figcaption></figure><div class="newsletter-signup"><h3>Enjoying this?</h3><p>Get one story a week by mail.</p><form><input name=m><button>Join</button></form></div>
        <p>Not all owls are so gifted: those that hunt by day have ears like ours.</p></article><div id="disqus_thread" class="discussion"><p>Lovely piece, thank you!</p></div><footer>Field Notes is printed on paper.</footer>""",
        ["How owls hear", "An owl’s ears do not sit level. One is higher than the other, and it's this that tells it how high a mouse stands.", "The face is a dish. Feathers round its rim send the sound inward; a barn owl can strike in full darkness.",
         "A barn owl in flight.", "Not all owls are so gifted: those that hunt by day have ears like ours."],
    ),
    (  # nothing to read: a log-in page
        """<html><body><div class="header"><a href="/">Portal</a></div><div class="login-box"><form><label>User</label><input><label>Password</label><input type=password><p>Forgotten your password?</p></form></div><div class="footer"><p>&copy; Portal Inc.</p></div></body></html>""",
        [],
    ),
]


def scores(chain) -> tuple[float, float]:
    """(precision, recall) over the blocks of all pages."""
    right = found = wanted = 0
    for html, want in PAGES:
        got = [t for t in html_crf.extract(html, chain).split("\n\n") if t]
        right += sum(min(got.count(t), want.count(t)) for t in set(got))
        found, wanted = found + len(got), wanted + len(want)
    return right / found, right / wanted


def test_no_main_text_is_lost_before_the_chain():
    for html, want in PAGES:
        texts = [b.text for b in html_crf.blocks(html)]
        assert [t for t in want if t not in texts] == []


def test_precision_and_recall():
    precision, recall = scores(html_crf.default_chain())
    print(f"precision {precision:.3f}, recall {recall:.3f}")
    assert precision >= 0.95 and recall >= 0.95
