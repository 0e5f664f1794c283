"""Pages written by hand, in the manner of many makers of sites, with their main texts."""

A = "The harbour town rebuilt its old market hall after the storm of last winter."
B = "Workers found beams from the seventeenth century under the floor, and kept them in place."
C = "Visitors may walk through the hall from April on; the upper gallery opens in June."
D = "The council has not yet said who will pay for the roof."
T = "Market hall opens again"

PAGES = {
    "article element": (f"<html><head><title>x</title></head><body><header><a href='/'>Daily Post</a></header><nav><ul><li><a href='/'>Home</a></li><li><a href='/s'>Sport</a></li></ul></nav><article><h1>{T}</h1><p>{A}</p><p>{B}</p></article><footer><p>© 2024 Daily Post. All rights reserved.</p></footer></body></html>", f"{T} {A} {B}"),
    "plain divs": (f"<body><div class='menu'><a href='/'>Home</a> <a href='/n'>News</a></div><div class='article'><h1>{T}</h1><div>{A}</div><div>{B}</div><div>{C}</div></div><div class='footer'>Contact | Imprint</div></body>", f"{T} {A} {B} {C}"),
    "table layout": (f"<table><tr><td><a href='/'>Home</a><br><a href='/a'>About us</a><br><a href='/c'>Contact</a></td><td><h1>{T}</h1><p>{A}</p><p>{B}</p></td></tr><tr><td colspan=2>Copyright 2003 by the town</td></tr></table>", f"{T} {A} {B}"),
    "main and aside": (f"<body><main id='content'><h1>{T}</h1><p>{A}</p><h2>What was found</h2><p>{B}</p></main><aside class='sidebar'><h3>Related articles</h3><ul><li><a href='/1'>Storm hits coast</a></li><li><a href='/2'>New mayor elected</a></li></ul></aside></body>", f"{T} {A} What was found {B}"),
    "cookie notice first": (f"<body><div id='cookie-banner' class='consent'><p>We use cookies to make this site work. You can accept all or manage your choices.</p><button>Accept all</button></div><div id='main'><h1>{T}</h1><p>{A}</p><p>{C}</p></div></body>", f"{T} {A} {C}"),
    "reader comments": (f"<article class='post'><h2>{T}</h2><p>{A}</p><p>{B}</p></article><section id='comments'><h3>2 comments</h3><div class='comment'><p>Anna says</p><p>What a lovely hall, I went there as a child with my mother.</p></div><div class='comment'><p>Too expensive if you ask me, the roof alone will ruin us.</p></div></section>", f"{T} {A} {B}"),
    "breaks only": (f"<div class='nav'><a href='/'>Home</a> | <a href='/b'>Back</a></div><div class='content'><h1>{T}</h1>{A}<br><br>{B}<br><br>{C}</div><div class='footer'>Terms of use</div>", f"{T} {A} {B} {C}"),
    "advert within": (f"<article><h1>{T}</h1><p>{A}</p><div class='ad advertisement'>Advertisement: buy now, free shipping on all boots.</div><p>{B}</p><p>{C}</p></article>", f"{T} {A} {B} {C}"),
    "lists and quotes": (f"<main><h1>{T}</h1><p>{A}</p><ul><li>The floor was laid anew.</li><li>The gallery was made safe.</li></ul><blockquote>{D}</blockquote></main><form class='search'><label>Search</label><input><button>Go</button></form>", f"{T} {A} The floor was laid anew. The gallery was made safe. {D}"),
    "references": (f"<div class=post-content><h1>Caf&eacute; &amp; market</h1><p>{A} It cost &pound;3&nbsp;million &#8212; at least.</p><p>{B}</p></div><ul class=share><li><a href=x>Tweet</a><li><a href=y>Facebook</a></ul>", f"Café & market {A} It cost £3 million — at least. {B}"),
    "unclosed tags": (f"<body><div class=header>My page<div class=nav><a href=1>Home</a><a href=2>News</a></div></div><div class=entry-content><h1>{T}</h1><p>{A}<p>{B}<p>{C}</div><div class=footer>Imprint", f"{T} {A} {B} {C}"),
    "scripts between": (f"<body><script>if (a < b) document.write('<p>no</p>')</script><noscript>Please enable scripts.</noscript><article><h1>{T}</h1><style>p{{color:red}}</style><p>{A}</p><script>track()</script><p>{D}</p></article></body>", f"{T} {A} {D}"),
    "unclosed noscript": (f"<body><noscript><img src=x><article><h1>{T}</h1><p>{A}</p><p>{B}</p></article></body>", f"{T} {A} {B}"),
    "newsletter within": (f"<div class='article-body'><h1>{T}</h1><p>{A}</p><div class='newsletter subscribe'><p>Subscribe to our newsletter</p><form><input><button>Sign up</button></form></div><p>{B}</p></div>", f"{T} {A} {B}"),
    "German page": ("<body><nav><ul><li><a href='/'>Startseite</a></li><li><a href='/k'>Kontakt</a></li></ul></nav><article><h1>Markthalle wieder offen</h1><p>Die Stadt am Hafen hat ihre alte Markthalle nach dem Sturm wieder aufgebaut.</p><p>Unter dem Boden fanden Arbeiter alte Balken.</p></article><footer>Impressum</footer></body>", "Markthalle wieder offen Die Stadt am Hafen hat ihre alte Markthalle nach dem Sturm wieder aufgebaut. Unter dem Boden fanden Arbeiter alte Balken."),
    "pre and figure": (f"<main><h1>{T}</h1><p>{A}</p><figure><img src=h.jpg><figcaption>The hall in May.</figcaption></figure><pre>open  10-18\nshut  Monday</pre></main>", f"{T} {A} The hall in May. open 10-18 shut Monday"),
}
