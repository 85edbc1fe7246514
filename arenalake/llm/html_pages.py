"""The labelled table that the block classifier learns from.

Each page is a list of lines; a line's blocks belong to the article (+) or do not (-). A number in
braces stands for that many words, with a full stop if they are more than four.
"""

from __future__ import annotations

LABELLED_PAGES = [
    """- <html><head><title>{6}</title></head><body><nav><ul><li><a href="/">{1}</a></li><li><a href="/">{1}</a></li><li><a href="/">{2}</a></li></ul></nav>
- <div class="ad">{8}</div>
+ <article><h1>{6}</h1>
+ <p>{60}</p>
+ <p>{1}</p>
+ <p>{2}</p><p>{120}</p><p>{9}</p><p>{30}</p>
+ <p>{4}</p></article>
- <footer>&copy; {6}</footer></body></html>""",
    """- <nav><ul><li><a href="/">{1}</a></li><li><a href="/">{3}</a></li><li><a href="/">{2}</a></li></ul></nav>
- <div class="ad">{25}</div>
+ <article><h1>{12}</h1><p>{3}</p></article>
- <footer>&copy; site.example &middot; {7}</footer>""",
    """- <header><a href="/">{2}</a><p>{5}</p></header>
- <nav><a href="/">{1}</a> <a href="/">{1}</a> <a href="/">{1}</a></nav>
+ <main><article><h1>{5}</h1>
+ <p>{45}</p><h2>{3}</h2><p>{70} <a href="/">{2}</a> {10}</p><blockquote>{14}</blockquote>
+ <ul><li>{6}</li><li>{1}</li><li>{9}</li></ul>
+ <p>{1}</p><p>{30}</p></article>
- <aside><h3>{2}</h3><ul><li><a href="/">{6}</a></li><li><a href="/">{7}</a></li></ul><p>{30}</p></aside></main>
- <section id="comments"><h2>{2}</h2><div class="comment"><p>{25}</p></div><div class="comment"><p>{3}</p></div></section>
- <form><label>{2}</label><p>{9}</p></form>
- <footer><p>{20}</p><a href="/">{1}</a> <a href="/">{2}</a></footer>""",
    """- <div class="cookie-notice"><p>{22}</p></div>
- <div id="header"><p>{3}</p></div>
+ <article><header><h1>{7}</h1></header>
+ <p>{50}</p><p>{80}</p>
- <div class="ad"><p>{15}</p></div>
+ <p>{20}</p><p>{2}</p>
- <ul class="share"><li><a href="/">{1}</a></li><li><a href="/">{1}</a></li></ul>
- <section class="comments"><h3>{2}</h3><article><p>{40}</p></article><article><p>{5}</p></article></section></article>
- <div class="footer">&copy; {4}</div>""",
    """- <div id="menu"><a href="/">{1}</a> | <a href="/">{1}</a> | <a href="/">{2}</a></div>
+ <div class="post"><h1>{5}</h1><div class="post-content"><p>{35}</p><p>{3}</p><p>{60}</p></div>
- <div class="comments"><p>{30}</p><p>{1}</p></div></div>
- <div class="sidebar"><h4>{1}</h4><p>{25}</p></div>
- <div id="footer"><p>{10}</p></div>""",
    """- <table><tr><td><a href="/">{1}</a></td><td><a href="/">{1}</a></td><td><a href="/">{2}</a></td></tr></table>
+ <h1>{6}</h1>
+ <p>{40}</p><p>{55}</p><p>{18}</p><p>{30}</p><p>{64}</p>
- <p><a href="/">{3}</a> <a href="/">{2}</a></p>
- <p>&copy; {4}</p>""",
    """- <div><a href="/">{1}</a></div><div><a href="/">{2}</a></div>
+ <div><h2>{4}</h2><div>{90}</div><div>{45}</div><div>{25} <a href="/">{3}</a></div></div>
- <div><a href="/">{8}</a></div><div><a href="/">{9}</a></div><div><a href="/">{2}</a></div>
- <div>Copyright {5}</div>""",
    """- <p><a href="/">{2}</a></p><p><a href="/">{1}</a></p>
+ <h1>{3}</h1><p>{22}</p><p>{28}</p><p>{19}</p><p>{40}</p>
- <p><a href="/">{4}</a></p><p><a href="/">{5}</a></p>
- <p>{2}</p>""",
    """- <body><div role="banner">{4}</div><div role="navigation"><ul><li><a href="/">{2}</a></li><li><a href="/">{1}</a></li></ul></div>
+ <div role="main"><h1>{8}</h1><p>{33}</p><figure><figcaption>{9}</figcaption></figure><p>{7}</p><table><tr><td>{2}</td><td>{1}</td></tr></table>
+ <p>{100}</p></div>
- <div role="complementary"><p>{45}</p></div><div role="contentinfo"><p>{12}</p></div>""",
    """- <nav>{3}</nav><aside>{18}</aside>
+ <article><h1>{4}</h1><p>{5}</p><p>{8}</p><p><a href="/">{4}</a></p><p>{2}</p>
+ <p>{7} <a href="/">{6}</a></p></article>
- <aside><article><h3>{5}</h3><p>{35}</p></article><article><h3>{4}</h3><p>{12}</p></article></aside>
- <form><p>{3}</p></form><footer><p>{40}</p></footer>""",
    """- <header><h1>{3}</h1><p>{12}</p></header>
+ <article><h1>{9}</h1><p>{200}</p><p>{150}</p><p>{12}</p>
+ <ol><li>{20}</li><li>{30}</li></ol><p>{1}</p>
- <footer><p>{15}</p><ul><li><a href="/">{1}</a></li></ul></footer></article>
- <div class="newsletter"><p>{18}</p></div>
- <footer>{9}</footer>""",
    """- <div class="topbar">{6}</div>
+ <article><div class="content"><h1>{6}</h1><p>{14}</p><h2>{1}</h2><p>{3}</p><pre>{16}</pre></div>
- <header><p>{4}</p></header>
- <div class="byline"><p>{5}</p></div>
- <p class="ad">{30}</p>
- <ul class="tags"><li><a href="/">{1}</a></li><li>{1}</li></ul>
- <div id="disqus"><p>{50}</p></div></article>
- <div class="popup">{14}</div><div hidden>{20}</div>""",
    """- <nav><ul><li><a href="/">{1}</a></li></ul></nav>
- <div class="banner">{5}</div><div class="login"><p>{6}</p></div>
+ <article><h1>{2}</h1><p>{1}</p><p>{1}</p><p>{3}</p></article>
- <div class="related"><h3>{1}</h3><p>{28}</p><p><a href="/">{8}</a></p></div>
- <div>{16}</div><p>{60}</p>
- <footer>{4}</footer>""",
    """- <div><a href="/">{2}</a> <a href="/">{2}</a></div>
- <section class="sponsored"><p>{40}</p><p>{21}</p></section>
+ <section><h1>{5}</h1><p>{48}</p><p>{31}</p><p>{16}</p></section>
- <section class="related-posts"><p>{20}</p><p>{24}</p></section>
- <section><p>{3}</p></section>""",
    """- <header>{5}</header><nav><a href="/">{2}</a></nav>
+ <article><header><h1>{4}</h1>
- <p>{6}</p></header>
+ <p>{30}</p><section><h2>{2}</h2><p>{25}</p><p>{1}</p></section>
- <nav><ul><li><a href="/">{2}</a></li><li><a href="/">{3}</a></li></ul></nav>
+ <section><p>{11}</p></section></article>
- <div class="pagination"><a href="/">{1}</a></div>
- <div class="disclaimer">{33}</div>""",
    """- <div>{7}</div>
+ <article><h1>{10}</h1><p>{5}</p><p>{300}</p><p>{1}</p><p>{44}</p></article>
- <div>{2}</div><p>{25}</p>""",
    """- <header><p>{40}</p><p>{30}</p></header>
- <div><a href="/">{12}</a> <a href="/">{9}</a> <a href="/">{14}</a></div>
+ <h1>{4}</h1><div>{70}</div><div>{42}</div><div>{38}</div>
- <div><a href="/">{20}</a> {2} <a href="/">{18}</a></div><div><a href="/">{30}</a></div>
- <footer><p>{50}</p></footer>""",
    """- <p>{2} <a href="/">{28}</a></p>
+ <h2>{6}</h2><p>{33}</p><p>{27} <a href="/">{4}</a></p><p>{61}</p>
- <p><a href="/">{16}</a> {3} <a href="/">{22}</a></p><p><a href="/">{40}</a></p>""",
    """- <nav>{2}</nav>
+ <article><h1>{6}</h1><p>{52}</p><p>{20} <a href="/">{9}</a></p><ul><li>{4}</li><li>{13} <a href="/">{2}</a></li></ul>
- <ul><li><a href="/">{6}</a></li><li><a href="/">{7}</a></li><li><a href="/">{5}</a></li></ul>
+ <p>{18}</p>
- <footer><p>{2}</p><p>{20}</p></footer></article>""",
    """- <div class="menu"><a href="/">{1}</a></div>
+ <article><h1>{5}</h1><p>{28}</p>
- <ul><li><a href="/">{2}</a></li><li><a href="/">{3}</a></li><li><a href="/">{12}</a></li></ul>
+ <p>{41}</p></article>
- <footer><p>{1}</p><p>{3}</p></footer>""",
    """- <div class="ad">{9}</div>
+ <article><h1>{4}</h1><p>{1}</p><p>{26}</p><p>{1}</p></article>""",
    """- <nav><a href="/">{2}</a></nav>
+ <article><p>{3}</p></article>""",
    """- <header>{4}</header>
+ <article><h1>{2}</h1><p>{2}</p><p><a href="/">{5}</a></p><p>{1}</p><p><a href="/">{3}</a></p><p><a href="/">{12}</a></p><p>{6}</p>""",
    """+ <article><h1>{8}</h1><p>{90}</p></article>""",
    """- <div><a href="/">{1}</a></div><p>{4}</p>
+ <h1>{5}</h1><p>{44}</p><p>{3}</p><p>{38}</p><p>{50}</p>
- <p>{3}</p><div><a href="/">{6}</a></div>""",
    """- <div>{3}</div>
+ <p>{52}</p><p>{47}</p><p>{66}</p>
- <p>{2}</p>""",
    """- <div>{5}</div><div>{1}</div>
+ <p>{29}</p><p>{35}</p>
- <p>{4}</p><p>{2}</p>""",
    """- <header><p>{2}</p><p>{30}</p></header>
+ <article><header><h1>{5}</h1>
- <p>{4}</p><p>{12}</p><p>{2}</p></header>
+ <p>{2}</p><p>{15}</p>
- <footer><p>{9}</p><p>{30}</p></footer></article>""",
]
