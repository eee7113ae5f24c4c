"""Scraped pages as nested records. Parsing runs on the standard library in Arrow batches, over a column of pages."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from html.parser import HTMLParser
from urllib.parse import urljoin

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..runtime import cut

VOID = set("area base br col embed hr img input link meta source track wbr".split())
CLOSES = {"li": {"li"}, "p": {"p"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}


class Node:
    """An element with its attributes, children and text."""

    def __init__(self, tag: str, attrs: dict[str, str], parent: Node | None) -> None:
        self.tag, self.attrs, self.parent = tag, attrs, parent
        self.children: list[Node | str] = []

    @property
    def classes(self) -> list[str]:
        return (self.attrs.get("class") or "").split()

    def walk(self) -> Iterator[Node]:
        """All elements below, in document order, without recursion: pages may nest deeply."""
        stack = [c for c in reversed(self.children) if isinstance(c, Node)]
        while stack:
            n = stack.pop()
            yield n
            stack += [c for c in reversed(n.children) if isinstance(c, Node)]

    def all(self, tag: str | None = None, cls: str | None = None) -> list[Node]:
        return [n for n in self.walk() if (tag is None or n.tag == tag) and (cls is None or cls in n.classes)]

    def first(self, tag: str | None = None, cls: str | None = None) -> Node | None:
        return next((n for n in self.walk() if (tag is None or n.tag == tag) and (cls is None or cls in n.classes)), None)

    def after(self, tag: str, cls: str | None = None) -> Node | None:
        """The next sibling of that kind."""
        if self.parent is None:
            return None
        own = self.parent.children
        behind = own[next(i for i, c in enumerate(own) if c is self) + 1 :]
        return next((n for n in behind if isinstance(n, Node) and n.tag == tag and (cls is None or cls in n.classes)), None)

    def text(self, br: str = "", skip: Node | None = None) -> str:
        out, stack = [], list(reversed(self.children))
        while stack:
            c = stack.pop()
            if isinstance(c, str):
                out.append(c)
            elif c.tag == "br":
                out.append(br)
            elif c is not skip and c.tag not in ("script", "style"):
                stack += reversed(c.children)
        return "".join(out)


class _Tree(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("", {}, None)

    def handle_starttag(self, tag, attrs):
        if self.at.tag in CLOSES.get(tag, ()):
            self.at = self.at.parent
        node = Node(tag, {k: v or "" for k, v in attrs}, self.at)
        self.at.children.append(node)
        if tag not in VOID:
            self.at = node

    def handle_startendtag(self, tag, attrs):
        self.at.children.append(Node(tag, {k: v or "" for k, v in attrs}, self.at))

    def handle_endtag(self, tag):
        n = self.at
        while n is not None and n.tag != tag:
            n = n.parent
        if n is not None and n.parent is not None:
            self.at = n.parent

    def handle_data(self, data):
        self.at.children.append(data)


def tree(page: str | None) -> Node:
    """The elements of a page; unclosed and stray tags do no harm."""
    t = _Tree()
    t.feed(page or "")
    t.close()
    return t.root


#: The classes of the pages' elements, written out where they are used.


def _said(n: Node | None, default: str = "") -> str:
    return n.text().strip() if n else default


def _href(n: Node | None) -> str:
    return n.attrs.get("href", "").strip() if n else ""


def _card(box: Node | None, br: str = "", keep_label: bool = False) -> dict[str, str]:
    """Labels in bold with the rest of their line."""
    out = {}
    for li in box.all("li") if box else []:
        label = li.first("strong")
        if label and "lesahumanidad-datos-sentencia-archivo" not in li.classes:
            key = label.text().strip()
            key = key.rstrip(":").strip() if keep_label else key.replace(":", "").strip().lower().replace(" ", "_")
            out[key] = li.text(br, skip=label).strip()
    return out


def _behind(article: Node, cls: str, br: str = "") -> str:
    head = article.first("h4", cls)
    p = head.after("p") if head else None
    return p.text(br).strip() if p else ""


def _image(article: Node, cls: str) -> str:
    box = article.first("div", cls)
    img = box.first("img") if box else None
    return img.attrs.get("src", "") if img else ""


def _crimes(td: Node | None, keep_blank: bool) -> list[str]:
    parts = [x.strip() for x in td.text().split(",")] if td else []
    return parts if keep_blank else [x for x in parts if x]


def _table(block: Node, table: str, who: str, crimes: str, name: str, link: str | None, keep_blank: bool, base: str = "") -> list[dict]:
    found = block.after("table", table)
    body = found.first("tbody") if found else None
    out = []
    for tr in body.all("tr") if body else []:
        td = tr.first("td", who)
        if td is None and keep_blank:
            continue
        a = td.first("a", link) if td else None
        out.append({f"{name}_nombre": _said(a or td), f"{name}_url": _absolute(_href(a), base), "delitos": _crimes(tr.first("td", crimes), keep_blank)})
    return out


def _absolute(url: str, base: str) -> str:
    return base.rstrip("/") + url if base and url.startswith("/") else url


def centre(page: str, url: str) -> dict | None:
    article = tree(page).first("article", "centrodetencion")
    if article is None:
        return None
    sections = {}
    for div in article.all("div", "lesahumanidad-datos-ccd"):
        head = div.first(cls="lesahumanidad-ccd-subtitulo")
        if head:
            sections[_said(head)] = "\n".join(t for p in div.all("p") if (t := _said(p)))
    box = article.first("div", "lesahumanidad-victimas-de-un-ccd")
    links = box.all("a", "lesahumanidad-link-victima") if box else []
    return {
        "source_url": url, "titulo": _said(article.first("h1"), "Sin Título"), "metadatos": _card(article.first("div", "lesahumanidad-ficha-items-ccd"), keep_label=True), "secciones": sections,
        "victimas": [{"nombre": _said(a), "url": urljoin(url, _href(a))} for a in links],
    }


def victim(page: str, url: str) -> dict | None:
    article = tree(page).first("article", "victima")
    if article is None:
        return None
    box = article.first("div", "lesahumanidad-ccds-de-una-victima")
    places = [a for li in box.all("li") if (a := li.first("a", "lesahumanidad-link-ccd"))] if box else []
    sentences = []
    for block in article.all("div", "lesahumanidad-agrupamiento-tabla-sentencia"):
        a = block.first("a", "lesahumanidad-link-sentencia")
        if a:
            rows = _table(
                block, "lesahumanidad-tabla", "lesahumanidad-tabla-victimas-sentencias-imputados-campo-imputado", "lesahumanidad-tabla-victimas-sentencias-imputados-campo-delitos",
                "imputado", "lesahumanidad-link-imputado", True,
            )
            sentences.append({"sentencia_nombre": _said(a), "sentencia_url": _href(a), "imputados": rows})
    return {
        "source_url": url, "nombre": _said(article.first("h1"), "Desconocido"), "imagen_url": _image(article, "lesahumanidad-contenedor-img"), "datos_personales": _card(article.first("div", "lesahumanidad-ficha-items")),
        "relato_hechos": _behind(article, "lesahumanidad-victima-subtitulo"), "centros_clandestinos": [{"nombre": _said(a), "url": _href(a)} for a in places], "sentencias": sentences,
    }


def accused(page: str, url: str) -> dict | None:
    article = tree(page).first("article", "imputado")
    if article is None:
        return None
    sentences = []
    for block in article.all("div", "lesahumanidad-agrupamiento-tabla-sentencia"):
        a = block.first("a", "lesahumanidad-link-sentencia")
        if a:
            rows = _table(
                block, "lesahumanidad-tabla-sentencias-victimas-imputados", "lesahumanidad-tabla-sentencias-victimas-imputados-campo-victima",
                "lesahumanidad-tabla-sentencias-victimas-imputados-campo-delitos", "victima", "lesahumanidad-link-victima", True,
            )
            sentences.append({"sentencia_nombre": _said(a), "sentencia_url": _href(a), "victimas_asociadas": rows})
    table = article.first("table", "lesahumanidad-tabla-imputados-condenas")
    body = table.first("tbody") if table else None
    convictions = []
    for tr in body.all("tr") if body else []:
        what, penalty = (tr.first("td", x) for x in ("lesahumanidad-tabla-imputados-condenas-campo-sentencias", "lesahumanidad-tabla-imputados-condenas-campo-sanciones"))
        if what and penalty:
            a = what.first("a", "lesahumanidad-link-sentencia")
            convictions.append({"sentencia_nombre": _said(a or what), "sentencia_url": _href(a), "sancion": _said(penalty)})
    return {
        "source_url": url, "nombre": _said(article.first("h1"), "Desconocido"), "imagen_url": _image(article, "lesahumanidad-imputado-contenedor-img"), "datos_personales": _card(article.first("div", "lesahumanidad-ficha-items-imputado")),
        "mas_informacion": _behind(article, "lesahumanidad-imputado-subtitulo"), "sentencias_y_victimas": sentences, "condenas_recibidas": convictions,
    }


def sentence(page: str, url: str) -> dict | None:
    article = tree(page).first("article", "sentencia")
    if article is None:
        return None
    box = article.first("div", "lesahumanidad-ficha-items-sentencia")
    card = _card(box, ", ")
    pdf = next((a for a in box.all("a") if "href" in a.attrs), None) if box else None
    if pdf:
        card["sentencia_completa_pdf"] = pdf.attrs["href"]
    victims = []
    base = urljoin(url, "/")
    for block in article.all("div", "lesahumanidad-agrupamiento-tabla-sentencia"):
        a = block.first("a", "lesahumanidad-link-victima")
        victims.append({
            "victima_nombre": _said(a) if a else block.text().replace("Víctima:", "").strip(), "victima_url": _absolute(_href(a), base),
            "imputados": _table(
                block, "lesahumanidad-tabla-sentencias-victimas-imputados", "lesahumanidad-tabla-sentencias-victimas-imputados-campo-imputado",
                "lesahumanidad-tabla-sentencias-victimas-imputados-campo-delitos", "imputado", None, False, base,
            ),
        })
    return {"url_detalle": url, "titulo": _said(article.first("h1")), "datos_tecnicos": card, "resumen": _behind(article, "lesahumanidad-sentencia-subtitulo", "\n"), "victimas_e_imputados": victims}


def list_links(page: str, url: str) -> dict:
    """The detail pages a list page leads to (more-buttons, else their card's link, else links of the kind), absolute, each once."""
    root = tree(page)
    links = [_href(a) for a in root.all("a", "lesahumanidad-link-btn-ver-mas")]
    for button in root.all("button", "btn-ver-mas"):
        up = button.parent
        while up is not None and up.tag not in ("a", "article", "div", "li"):
            up = up.parent
        a = up if up is not None and up.tag == "a" else up.first("a") if up else None
        links.append(_href(a))
    if not any(links):
        links = [h for a in root.all("a") if any(k in (h := _href(a)) for k in ("/victima/", "?victima=", "/imputado/", "?imputado="))]
    following = next((a for a in root.all("a", "next") if _href(a)), None)
    return {"enlaces": list(dict.fromkeys(urljoin(url, x) for x in links if x)), "siguiente": urljoin(url, _href(following)) if following else None}


_ROWS = "array<struct<{0}_nombre:string,{0}_url:string,delitos:array<string>>>"
SCHEMAS = {
    centre: "source_url string, titulo string, metadatos map<string,string>, secciones map<string,string>, victimas array<struct<nombre:string,url:string>>",
    victim: f"source_url string, nombre string, imagen_url string, datos_personales map<string,string>, relato_hechos string, centros_clandestinos array<struct<nombre:string,url:string>>, sentencias array<struct<sentencia_nombre:string,sentencia_url:string,imputados:{_ROWS.format('imputado')}>>",
    accused: f"source_url string, nombre string, imagen_url string, datos_personales map<string,string>, mas_informacion string, sentencias_y_victimas array<struct<sentencia_nombre:string,sentencia_url:string,victimas_asociadas:{_ROWS.format('victima')}>>, condenas_recibidas array<struct<sentencia_nombre:string,sentencia_url:string,sancion:string>>",
    sentence: f"url_detalle string, titulo string, datos_tecnicos map<string,string>, resumen string, victimas_e_imputados array<struct<victima_nombre:string,victima_url:string,imputados:{_ROWS.format('imputado')}>>",
    list_links: "enlaces array<string>, siguiente string",
}


def extract(pages: DataFrame, kind: Callable[[str, str], dict | None]) -> DataFrame:
    """The records of pages (url, html); pages of another kind, null and empty ones give no row."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            got = [kind(h, u or "") for u, h in zip(pdf["url"], pdf["html"], strict=True) if h]
            names = [c.split()[0] for c in _columns(SCHEMAS[kind])]
            yield pd.DataFrame([g for g in got if g is not None], columns=names)

    return pages.select("url", "html").mapInPandas(run, SCHEMAS[kind])


def crawl(pages: DataFrame, start: DataFrame, kind: Callable[[str, str], dict | None]) -> DataFrame:
    """The records of all detail pages that the list pages lead to: from the start pages (url) on, following each next page.

    pages: (url, html), each url once; links to pages that are not there lead nowhere. The frontier is a table: a round
    joins it to the pages, takes its links and its next pages, and leaves out pages already seen, so that lists that lead
    back end. A detail page linked several times is read once.
    """
    frontier, seen = cut(start.select("url").distinct()), start.select("url").distinct()
    links: DataFrame | None = None
    while frontier.take(1):
        listed = pages.join(frontier, "url").select("url", "html")
        found = cut(extract(listed, list_links))
        own = found.select(F.explode("enlaces").alias("url"))
        links = own if links is None else links.unionByName(own)
        frontier = cut(found.where("siguiente is not null").select(F.col("siguiente").alias("url")).distinct().join(seen, "url", "left_anti"))
        seen = cut(seen.unionByName(frontier))
    if links is None:
        links = start.select("url").limit(0)
    return extract(pages.join(links.distinct(), "url"), kind)


def _columns(schema: str) -> list[str]:
    out, depth, at = [], 0, ""
    for c in schema:
        depth += (c == "<") - (c == ">")
        if c == "," and not depth:
            out.append(at.strip())
            at = ""
        else:
            at += c
    return [*out, at.strip()]
