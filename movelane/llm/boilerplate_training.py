"""Training of the page model on labelled pages: ``python -m movelane.llm.boilerplate_training PAGES.parquet``.

The labels follow the annotation guide below, written from the commonest shapes of lines and a look through pages;
a page counts only if every one of its lines has a label. At most MAX_PAGES pages are used, whatever the table holds.
Furniture of other sites (ELSEWHERE, written by hand) is put around and between the lines of these pages, so that the
field learns the words of furniture and not the lines of one corpus; what it makes of lines that it has never seen is
measured on others (tests).
"""

from __future__ import annotations

import random
import re
import sys
from collections import Counter

import numpy as np

from movelane.llm.boilerplate import BODY, STATES, Blocks, Model, emissions, line_features, page_context

MAX_PAGES = 4000
#: Pages read to find them: not every page has a label for each of its lines.
MAX_READ = 12_000
#: Features seen on fewer lines are no features.
MIN_LINES = 3

# The annotation guide: fixed texts of furniture, by how a line begins (lower case).
FURNITURE = """this site stores|to give you the best experience|your choices matter|we use cookies|cookies help us|en poursuivant|wir und unsere|diese seite verwendet
este sitio guarda|back to top|design:|terms of use|images supplied|member of the independent|bookmark|tweet  post|share:|share this article|want alerts|newsletter bestellen
get the morning note|already a subscriber|join |you have |abonnez-vous|- advert -|story continues|be the first to comment|loading comments|advertisement|sponsored content
promoted:|listen to this story|you are here|text size|reading time|topics|menu|search this site|previous article|next article|filed under|updated |skip to main|cart (|tags:
nothing on these pages|subscribe from|print  |contact the newsdesk|printed and published by|©|follow the author"""
SECTIONS = "read next|trending now|elsewhere|more from this section|related stories|you may also like|most read this week|editors' choice"
HEADS = "by |words:|photo:|picture:|above:"
MENU = """jobs|in-house|about|people|my account|log in|opinion|home|archive|regions|news|moves|podcasts|awards|insights|practice areas|data|careers|surveys|deals|courts|search
register|events|magazine|videos|help|contact|our offices|rankings"""
SUBHEADS = r"(background|the numbers|reaction|what comes next|a crowded market|terms|who follows|why [a-z ]{2,20})$"
HEADLINE = r"""(.+ hires .+ from .+|.+ promotes \d+ in .+|.+ leaves .+ after \d+ years.*|.+ round-up: .+ swap partners.*|.+ names .+|.+ joins .+ as .+|.+ opens in .+ with .+ team.*|.+ loses .+ head to .+|q&a: .+ on .+|.+ welcomes .+ in .+)"""
LISTED = r"(?:[-*•] ?)?[A-ZÀ-Ý][\w'’.\-]+(?: [A-ZÀ-Ý][\w'’.\-]+){1,3}(?:, [A-Z][\w ]+| \([A-Z][\w ]+\))$"


# Furniture as other sites have it, one a line, by hand.
ELSEWHERE = """Sign up to our free daily newsletter
Subscribe now for unlimited access to all our articles
Get the best of our reporting delivered to your inbox every week
Enter your email address to receive updates
By signing up you agree to our terms and conditions and privacy policy
We respect your privacy and will never share your details
Unsubscribe at any time using the link in our emails
This website uses cookies to improve your experience and to show relevant ads
Accept all cookies | Reject all | Manage preferences
You can change your cookie settings at any time in your browser
Read our privacy policy to find out how we use your personal data
We and our partners store and access information on your device
Your consent helps us to keep this site free
Download our app for iPhone and Android
Get our app from the App Store or Google Play
Follow us on Twitter, Facebook, LinkedIn and Instagram
Share on Facebook
Share this story with a friend
Copy link to clipboard
Print this page
Save for later
Add a comment
Leave a reply. Your email address will not be published.
Log in or register to post comments
Comments are closed for this article
Copyright 2023 Example Media Ltd. All rights reserved.
No part of this site may be reproduced without the written permission of the publisher.
Registered in England and Wales. Company number 01234567.
The information on this site is for general purposes only and is not legal or financial advice.
You should seek professional advice before acting on anything published here.
The publisher accepts no liability for the content of external sites.
Views expressed are those of the authors and do not reflect those of this publication.
This content is provided for information only and does not constitute advice.
Advertise with us
Advertisement - continue reading below
Sponsored by our partners
This article contains affiliate links for which we may earn a commission
Already a member? Log in here
Create a free account to continue reading
You have reached your limit of free articles this month
Start your free trial today and cancel at any time
Become a member and support independent journalism
Upgrade to premium for full access to our archive
Forgotten your password? Reset it here
Contact us | About us | Careers | Help | Site map
Terms and conditions | Privacy policy | Accessibility | Modern slavery statement
Home > News > Business
Skip to content
Back to homepage
Load more stories
View all articles
Next page
See more from this author
Recommended for you
Trending topics
Most popular today
Latest headlines
More stories like this
Join our mailing list for event invitations and special offers
Register for our upcoming webinar on regulation
Book your ticket for our annual conference now
Take our two minute reader survey and win a prize
Tell us what you think about this page
Report a problem with this page
If you have a story for us, email the news desk
To republish this article please contact our syndication team
Please enable cookies and refresh the page to continue
Your browser is out of date and may not display this site correctly
Powered by WordPress
Website design by Example Studio
All times are local unless stated otherwise
Prices are delayed by at least fifteen minutes
Photograph supplied. Click to enlarge.
Listen to this article in our podcast
Abonnez-vous à notre lettre d'information
Tous droits réservés. Mentions légales et politique de confidentialité.
Ce site utilise des cookies pour améliorer votre visite
Inscrivez-vous gratuitement pour lire la suite
Alle Rechte vorbehalten. Impressum und Datenschutz.
Diese Website verwendet Cookies, um Ihren Besuch zu verbessern
Melden Sie sich kostenlos an, um weiterzulesen
Suscríbase a nuestro boletín gratuito
Todos los derechos reservados. Aviso legal y política de privacidad.
Este sitio utiliza cookies para mejorar su experiencia""".split("\n")


def furnished(texts: list[str], labels: list[list[int]], seed: int = 0) -> tuple[list[str], list[list[int]]]:
    """Copies of pages with up to three lines of ELSEWHERE put in, mostly at their ends, labelled as furniture."""
    rng, kind = random.Random(seed), STATES.index("furniture")
    pages, states = [], []
    for text, label_row in zip(texts, labels):
        lines, row = [line for line in text.split("\n") if line.strip()], list(label_row)
        for line in rng.sample(ELSEWHERE, rng.randint(1, 3)):
            at = rng.choice([0, 0, len(lines), len(lines), len(lines), rng.randint(0, len(lines))])
            lines.insert(at, line)
            row.insert(at, kind)
        pages.append("\n".join(lines))
        states.append(row)
        # Some pages are an article and nothing else, or a paragraph of one.
        own = [i for i, s in enumerate(row) if s == BODY]
        if own and rng.random() < 0.2:
            first = rng.choice(own)
            some = [i for i in own if first <= i < first + rng.randint(1, 3)]
            pages.append("\n".join(lines[i] for i in some))
            states.append([BODY] * len(some))
    return pages, states


def _words(text: str) -> list[str]:
    return [w for line in text.split("\n") for w in line.split("|")]


_FURNITURE, _SECTIONS, _HEADS, _MENU = map(tuple, map(_words, (FURNITURE, SECTIONS, HEADS, MENU)))


def label(line: str) -> int | None:
    """The state of a line by the guide; None if the guide doesn't tell."""
    text = line.strip()
    low = text.lower()
    state = STATES.index
    if low in _MENU or re.match(r"\d+ (shares|comments)$", low):
        return state("furniture")
    if re.match(SUBHEADS, low):
        return BODY
    if low in _SECTIONS:
        return state("teaser")
    if low.startswith(_HEADS):
        return state("head")
    if re.search(r" is published from .*registered office", low) or (low.startswith(_FURNITURE) and not re.search(r"\b(said|told)\b", low)):
        return state("furniture")
    if re.match(LISTED, text):
        return BODY
    first = re.split(r"(?<=[a-z)0-9])\.+ ", re.sub(r"\b(pte|ltd|co|l\.l\.p)\.", lambda m: m[1].replace(".", ""), low))[0]
    if re.match(r"(see also|also|more|read|related)\b.*[-:]|>> |\d+\. ", low) or (re.match(HEADLINE, first) and not re.search(r"\bhas hired\b", first)):
        return state("teaser")
    if re.search(r"\||›| · |   | / ", text) and not re.search(r"[.!?]$", text):
        return state("furniture")
    return BODY if re.search(r"[.!?。][\"”»“)]?$", text) else None


def labelled(texts: list[str | None]) -> list[tuple[int, list[int]]]:
    """(row, labels) of the pages whose every line the guide labels; the first headline above the body is a head."""
    out = []
    for i, text in enumerate(texts):
        states = [label(line) for line in (text or "").split("\n") if line.strip()]
        if not states or None in states:
            continue
        top = next((k for k, s in enumerate(states) if s in (BODY, STATES.index("teaser"))), None)
        if top is not None and states[top] == STATES.index("teaser"):
            states[top] = STATES.index("head")
        out.append((i, states))
    return out


def feature_index(texts: list[str]) -> dict[str, int]:
    seen: Counter = Counter()
    for text in texts:
        lines = [line.strip() for line in text.split("\n") if line.strip()]
        entries = [line_features(line) for line in lines]
        for i, (names, _) in enumerate(entries):
            seen.update(set(names))
            seen.update(page_context([e[1] for e in entries], i, lines.count(lines[i]) > 1, False))
    names = sorted(n for n, k in seen.items() if k >= MIN_LINES) + ["head=True"]
    return {n: i for i, n in enumerate(dict.fromkeys(names))}


def _logsum(x: np.ndarray, axis: int) -> np.ndarray:
    top = x.max(axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(x - top).sum(axis))


def fit(texts: list[str], headlines: list[str | None], labels: list[list[int]], rounds: int = 120, rate: float = 0.08, ridge: float = 1.0, seed: int = 0) -> Model:
    """Maximum likelihood with an L2 penalty by Adam over all pages; forward and backward run over pages at once."""
    index = feature_index(texts)
    blocks = Blocks(index)
    pages = [blocks.page(t, h)[1] for t, h in zip(texts, headlines)]
    k = len(STATES)
    flat = [ids for page in pages for ids in page]
    rows = np.concatenate([np.asarray(ids, dtype=np.int64) for ids in flat])
    owner = np.repeat(np.arange(len(flat)), [len(ids) for ids in flat])
    sizes = np.array([len(p) for p in pages])
    length, count = int(sizes.max()), len(pages)
    mask = np.arange(length)[None, :] < sizes[:, None]
    gold = np.zeros((count, length), dtype=np.int64)
    gold[mask] = np.concatenate([np.asarray(x) for x in labels])
    parameters = [np.zeros((len(index), k)), np.zeros(k), np.zeros((k, k))]
    first, second = [np.zeros_like(p) for p in parameters], [np.zeros_like(p) for p in parameters]
    one_hot = np.eye(k)
    for turn in range(1, rounds + 1):
        weights, start, step = parameters
        scores, _ = emissions(pages, weights)
        alpha = np.zeros((count, length, k))
        alpha[:, 0] = scores[:, 0] + start
        for i in range(1, length):
            alpha[:, i] = _logsum(alpha[:, i - 1, :, None] + step[None], 1) + scores[:, i]
        beta = np.zeros((count, length, k))
        for i in range(length - 2, -1, -1):
            onward = _logsum(step[None] + (scores[:, i + 1] + beta[:, i + 1])[:, None, :], 2)
            beta[:, i] = np.where((sizes > i + 1)[:, None], onward, 0.0)
        total = _logsum(alpha[np.arange(count), sizes - 1], 1)
        marginal = np.exp(alpha + beta - total[:, None, None])
        moves = np.zeros((k, k))
        for i in range(1, length):
            live = sizes > i
            pair = alpha[live, i - 1, :, None] + step[None] + (scores[live, i] + beta[live, i])[:, None, :] - total[live][:, None, None]
            moves += np.exp(pair).sum(0)
            moves -= (one_hot[gold[live, i - 1]][:, :, None] * one_hot[gold[live, i]][:, None, :]).sum(0)
        error = (marginal - one_hot[gold])[mask]
        slope = np.stack([np.bincount(rows, weights=error[owner, s], minlength=len(index)) for s in range(k)], axis=1)
        gradients = [slope + ridge * weights, (marginal[:, 0] - one_hot[gold[:, 0]]).sum(0) + ridge * start, moves + ridge * step]
        for j, g in enumerate(gradients):
            first[j] = 0.9 * first[j] + 0.1 * g
            second[j] = 0.999 * second[j] + 0.001 * g * g
            parameters[j] = parameters[j] - rate * (first[j] / (1 - 0.9**turn)) / (np.sqrt(second[j] / (1 - 0.999**turn)) + 1e-8)
    weights = parameters[0]
    used = [n for n, i in index.items() if np.abs(weights[i]).max() >= 0.02]
    return Model({n: i for i, n in enumerate(used)}, weights[[index[n] for n in used]], parameters[1], parameters[2])


def train(path: str) -> Model:
    """The model of the first pages of a parquet file, read a batch at a time until MAX_READ pages have been seen."""
    import pyarrow.parquet as pq

    table: list[dict] = []
    for batch in pq.ParquetFile(path).iter_batches(batch_size=1000, columns=["item_id", "headline", "body_text"]):
        table += batch.to_pylist()
        if len(table) >= MAX_READ:
            break
    table = sorted(table[:MAX_READ], key=lambda row: row["item_id"])
    pages = labelled([row["body_text"] for row in table])[:MAX_PAGES]
    texts, titles, states = [table[i]["body_text"] for i, _ in pages], [table[i]["headline"] for i, _ in pages], [states for _, states in pages]
    more, more_states = furnished(texts, states)
    return fit(texts + more, titles + [None] * len(more), states + more_states)


if __name__ == "__main__":
    train(sys.argv[1]).save()
