"""Main text on pages of ten layouts, labelled by hand: words in [[ ]] are the article's."""

import re

import pyarrow.parquet as pq
import pytest

from ledgerlode.llm import html_blocks

LAYOUTS = {
    "plain_div": "<div id=wrap><div id=top><a href=/>Home</a> <a href=/b>Blog</a></div><div class=text><h1>[[Bees in winter]]</h1><p>[[The colony forms a tight ball around its queen, and the bees on the outside change places with those within.]]</p><p>[[They eat honey stored in autumn. A strong hive needs some fifteen kilos of it, more where winters are long.]]</p></div><div class=footer>Copyright 2019 A. Keeper</div></div>",
    "main_and_comments": "<header><a href=/>Garden notes</a></header><main><h1>[[Pruning roses]]</h1><p>[[Cut above a bud that faces outward, at a slant, so that rain runs off.]]</p><ul><li>[[Use sharp shears]]</li><li>[[Remove dead wood first]]</li></ul><pre>[[depth = 2 * width]]</pre><section class=comments><h2>Comments</h2><div class=comment><p>I always do this in March, and my roses have thanked me for it every summer.</p></div><div class=comment><p>Thank you for the hint.</p></div></section></main><footer>Imprint</footer>",
    "old_table": "<table width=100%><tr><td colspan=2><a href=/>Index</a> | <a href=/maps>Maps</a></td></tr><tr><td class=menu><a href=/1>Coast</a><br><a href=/2>Hills</a><br><a href=/3>Lakes</a></td><td><h2>[[The old lighthouse]]</h2><p>[[It was lit for the first time in 1832, when the harbour was still open to the north.]]<p>[[Two keepers lived there in turn, each for a month, with a cow and a small garden.]]</td></tr></table>",
    "article_with_boxes": "<body><nav><a href=/>Home</a></nav><article><header><h1>[[A bridge of stone]]</h1></header><p>[[The river was crossed here by ferry until the stones came down from the quarry, barge after barge.]]</p><aside class=related><h3>Related</h3><ul><li><a href=/x>Other bridges</a></li></ul></aside><p>[[In spring the water reaches the third arch; in dry years one can walk beneath it.]]</p><div class=share><a href=/s>Share this</a></div></article></body>",
    "post_in_content": "<div class=\"site\"><div class=\"cookie-banner\">We use cookies to make this site better for you. By staying you agree to it.</div><div class=\"content\"><div class=\"post\"><h1>[[Bread without kneading]]</h1><p>[[Flour, water, salt and a little yeast are stirred together in the evening.]]</p><blockquote><p>[[Time does the work that hands would do.]]</p></blockquote><p>[[In the morning the dough is folded twice and baked in a hot pot.]]</p></div><div class=\"sidebar\"><h3>Newsletter</h3><p>Sign up and get a recipe every week, free of charge.</p><form><input name=m><button>Send</button></form></div></div></div>",
    "sections": "<body><div class=masthead>The Daily Ferry</div><section id=s1><h1>[[Snow on the pass]]</h1><div>[[The road was closed on Monday, after a night of wind and drifting snow.]]</div><div>[[Ploughs reached the summit by noon, yet lorries had to wait for another day, said the warden.]]</div></section><section class=\"related\"><h2>More news</h2><a href=/1>Rain in the valley</a><a href=/2>Ferry late again</a></section></body>",
    "bare": "<h1>[[Notes on tea]]</h1><p>[[Green tea is steamed or roasted soon after picking, so the leaf keeps its colour.]]</p><p>[[Black tea is left to wither, rolled, and only then dried, which takes a full day.]]</p>",
    "nav_lists_without_names": "<body><div><ul><li><a href=/a>Start</a></li><li><a href=/b>Tours</a></li><li><a href=/c>Prices</a></li></ul></div><div><div><h1>[[Walking the dunes]]</h1><p>[[Keep to the marked paths, for the grass that holds the sand breaks easily.]]</p><p>[[From the last dune you see both the lagoon and the open sea, and on clear days the island.]]</p></div></div><div><ul><li><a href=/d>Contact</a></li><li><a href=/e>Privacy</a></li></ul></div></body>",
    "data_in_article": "<body><header class=page-header><a href=/>Metals</a></header><article class=entry><h1>[[Melting points]]</h1><p>[[The table lists the points at which three common metals melt, in degrees Celsius.]]</p><table><tbody><tr><td>[[Tin]]</td><td>[[232]]</td></tr><tr><td>[[Lead]]</td><td>[[327]]</td></tr><tr><td>[[Copper]]</td><td>[[1085]]</td></tr></tbody></table><figure><figcaption>[[Copper, cast]]</figcaption></figure></article><div class=advert>Buy fine copper pans now, at half the price.</div></body>",
    "story_and_replies": "<div class=container><div class=breadcrumb><a href=/>Home</a> &gt; <a href=/t>Tales</a></div><div class=story><h2>[[The miller's clock]]</h2><p>[[Once a miller owned a clock that struck thirteen, and nobody in the village minded.]]</p><p>[[When it was mended at last, half of them came late to church.]]</p></div><ol class=commentlist><li class=comment>What a lovely tale, my grandmother used to tell it as well.</li><li class=comment>Where is it from?</li></ol><div class=pager><a href=/2>Next tale</a></div></div>",
}

#: Written after the number of path buckets had been chosen on the ten above; two of these six then led to names being left out.
LATER = {
    "wiki": "<div id=mw-panel><ul><li><a href=/m>Main page</a></li><li><a href=/r>Random page</a></li></ul></div><div id=bodyContent><h1 id=firstHeading>[[Alder]]</h1><div class=mw-parser-output><p>[[Alders are trees of the birch family, common along rivers in the north, where their roots hold the banks.]]</p><h2>[[Wood]]</h2><p>[[The wood resists rot under water; piles of it still carry parts of old lagoon towns.]]</p><ul><li>[[black alder]]</li><li>[[grey alder]]</li></ul></div></div><div id=catlinks><a href=/c>Trees</a> <a href=/d>Rivers</a></div><div id=footer>Text is available under a free licence.</div>",
    "forum": "<div class=topbar><a href=/>Boat forum</a></div><div class=thread><div class=entry><h1>[[Leaking hatch]]</h1><p>[[My forward hatch lets in water at every wave, although I put in a new seal last year. The frame looks straight.]]</p></div><div class=replies><div class=reply><p>Check the hinges first, they pull the lid to one side on that type of boat.</p></div><div class=reply><p>Same here.</p></div></div></div>",
    "fonts": "<center><font size=6>[[The village band]]</font></center><p><font face=Arial>[[Founded by a baker in 1888, it has played at every fair since, but for the years of war.]]</font></p><p><font face=Arial>[[Rehearsals are held on Thursdays above the fire station, and guests may listen.]]</font></p><hr><center><a href=index.htm>Back</a> | <a href=guest.htm>Guest book</a></center>",
    "many_boxes": "<div class=header><div class=logo>Ridge Times</div></div><div class=promo>Subscribe for one euro a week.</div><div id=main><div class=article-body><h1>[[Wolves return]]</h1><p>[[Tracks in fresh snow gave the pack away, two adults and at least three young, rangers report.]]</p><div class=ad>Hiking boots on sale today only.</div><p>[[Shepherds ask for dogs and fences before the flocks go up in May.]]</p></div></div><div class=social><a href=/s>Follow us</a></div><footer><p>All rights reserved by Ridge Times.</p></footer>",
    "definitions": "<main><h1>[[Words of the mill]]</h1><dl><dt>[[Hopper]]</dt><dd>[[the funnel from which grain runs between the stones]]</dd><dt>[[Race]]</dt><dd>[[the channel that leads water to the wheel]]</dd></dl><p>[[Most of these words are still used by the three mills on the brook.]]</p></main><nav><a href=/n>Next</a></nav>",
    "hashed_names": "<div class=x1a9><div class=q7b><a href=/>Home</a><a href=/n>New</a></div><div class=zz3><div class=k2c><h1>[[Salt roads]]</h1></div><div class=k2d><div>[[Mules carried salt over the ridge until the railway came, each with two sacks and a bell.]]</div><div>[[The inns along the way are farms today, yet some still have the iron rings in the wall.]]</div></div></div><div class=f0f>\u00a9 2021 Road Society</div></div>",
}

#: Written after that; nothing was changed for them.
LAST = {
    "shop_blog": "<div id=shopify-section><div class=announcement-bar>Free shipping over 50</div></div><div class=template-article><div class=grid__item><div class=rte><h1>[[How to oil a board]]</h1><p>[[Wash the board, let it dry for a day, and rub in warm linseed oil with a cloth.]]</p><p>[[Repeat this three times in the first week, then once a season.]]</p></div></div></div><div class=newsletter-box><p>Get ten percent off your first order when you join our list today.</p></div>",
    "gazette": "<div class=wrapper><div class=col1><a href=/p>Politics</a><br><a href=/s>Sport</a><br><a href=/w>Weather</a></div><div class=col2><h2>[[Council buys the meadow]]</h2><div class=lead>[[The meadow by the weir will stay open to all, the council decided on Tuesday evening.]]</div><p>[[Building had been planned there since 1998, but the ground proved too wet.]]</p></div><div class=col3><div class=advertisement>New cars from the dealer at the ring road.</div></div></div>",
    "docs": "<div class=layout><nav class=toc><ul><li><a href=#a>Install</a></li><li><a href=#b>Use</a></li></ul></nav><div role=main><h1>[[Measuring tape]]</h1><p>[[Pull the tape until the hook rests on the edge, then press the lock.]]</p><h2>[[Use]]</h2><ol><li>[[Hold the case]]</li><li>[[Read the mark]]</li></ol><pre>[[length = mark + 8 cm]]</pre></div></div><div class=footer-links><a href=/i>Imprint</a></div>",
    "letter": "<body bgcolor=white><blockquote><p>[[Dear cousin, the harvest is in and the barn is full to the beams.]]<p>[[We have had no rain since Whitsun, and still the well holds.]]</blockquote></body>",
    "recipe": "<header class=site-header><a href=/>Spoon</a><form action=/q><input name=q></form></header><section class=recipe><h1>[[Lentil soup]]</h1><ul class=ingredients><li>[[200 g lentils]]</li><li>[[1 carrot]]</li></ul><p>[[Simmer the lentils for half an hour with the carrot, then add vinegar and salt.]]</p></section><section class=comments-area><div class=comment-body><p>Made this twice, the children asked for more.</p></div></section>",
    "nested_names": "<div class=a3><div class=b4><div class=c5><a href=/>Start</a></div></div><div class=d6><div class=e7><h1>[[Ice on the canal]]</h1><p>[[The boats lay fast for nine weeks, and people walked to market over the ice.]]</p></div><div class=g9><p>[[Only the ferryman was cross, having nobody to carry.]]</p></div></div></div><div class=h0><a href=/o>Older</a> <a href=/n>Newer</a></div>",
}


def words(text: str) -> list[str]:
    return re.findall(r"\w+", text)


@pytest.fixture(scope="module")
def model():
    return html_blocks.train(pq.read_table("/root/testdata/sf0.01/pages.parquet")["html"].to_pylist()[:150])


def measured(model, page: str) -> tuple[float, float]:
    wanted = [w for x in re.findall(r"\[\[(.*?)\]\]", page) for w in words(x)]
    found = html_blocks.leaves(page.replace("[[", "").replace("]]", ""))
    got = [w for x, keep in zip(found, model.label([found])[0], strict=True) if keep for w in words(x[1])]
    both = sum(min(wanted.count(w), got.count(w)) for w in set(wanted))
    return both / len(wanted), both / max(1, len(got))


@pytest.mark.parametrize("pages", (LAYOUTS, LATER, LAST), ids=("ten", "later", "last"))
def test_layouts(model, pages):
    figures = {k: measured(model, page) for k, page in pages.items()}
    assert sum(r for r, _ in figures.values()) / len(figures) >= 0.9, figures
    assert sum(p for _, p in figures.values()) / len(figures) >= 0.9, figures
    assert min(min(x) for x in figures.values()) >= 0.6, figures
