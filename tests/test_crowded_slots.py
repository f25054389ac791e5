"""Sessions of one slot with very many titles: the rows of comparing all, without making all pairs."""

import random
import re

from pyspark.sql import functions as F

from reelhouse.operators import match_schedule, match_session, title_keys

AT = (1, "2024-01-05", "19:00")
SESSION = "theater_id bigint, date string, time string, pos int, movie_name string, runtime_minutes int, language_code string, auditorium string, seats_remaining int, area_code string"
WANT = "theater_id bigint, date string, time string, title string, runtime int, language string"


def title(rnd, words=4):
    return " ".join("".join(rnd.choice("abcdefghijklmnopqrstuvw") for _ in range(rnd.randint(2, 9))) for _ in range(rnd.randint(1, words)))


def tables(spark, n, seed=3):
    rnd = random.Random(seed)
    names = [title(rnd) for _ in range(n)] + ["", None, "Été d'hiver", "ete"]
    minutes = lambda: rnd.choice([None, 0, *range(80, 140)])
    sessions = [(*AT, i, name, minutes(), rnd.choice(["FR", "EN", None]), f"Salle {i % 7}", i % 50, rnd.choice(["0000000001", "2", None])) for i, name in enumerate(names)]
    asked = [*rnd.sample(names[:n], n // 2), *[title(rnd) for _ in range(n // 2)], "", None, "été", "!!", "a", "zz"]
    wants = [(*AT, name, rnd.choice([None, *range(80, 145)]), rnd.choice(["FR", "EN", None])) for name in asked]
    return spark.createDataFrame(sessions, SESSION), spark.createDataFrame(wants, WANT), sessions, wants


def squished(text):
    folded = (text or "").lower().translate(str.maketrans("éè", "ee"))
    return re.sub("[^a-z0-9]+", " ", folded).strip(" ")


def plain_score(want, session):
    title_, runtime, language = want[3:]
    other, code = session[5] or None, session[6]
    off = None if runtime is None or other is None else abs(other - runtime)
    score = 0.5 if off is None else 0 if off <= 3 else 0.5 if off <= 6 else 1 if off <= 10 else 2
    score += 0.5 if language and code and language != code else 0
    a, b = squished(session[4]), squished(title_)
    if not a or not b:
        return score + 4
    shared = len(set(a) & set(b)) * 3 // min(len(set(a)), len(set(b)))
    return score + (0 if a == b else 1 if a in b or b in a else 3 - min(3, shared))


def test_scored_session_by_bounds(spark):
    sessions, wants, offered, asked = tables(spark, 300)
    got = {(r.title, r.runtime, r.language): r for r in match_session.scored_session(wants, sessions).collect()}
    direct = match_session.scored_session(wants, sessions, few=10**6).collect()
    assert sorted(map(str, direct)) == sorted(map(str, got.values()))
    for want in asked:
        best = sorted((plain_score(want, s), s[3]) for s in offered)[:3]
        r = got[want[3:]]
        if best[1][0] - best[0][0] < 0.25:
            assert (r.status, r.candidates) == ("AMBIGUOUS_AT_TIME", [p for _, p in best]), want
        else:
            assert (r.status, r.session_pos) == ("OK", best[0][1]), want


def test_few_titles_share_their_comparisons(spark, monkeypatch):
    """Of 40 wanted titles in 2,400 shapes nothing is written per want and class, and the rows are those of comparing all."""
    sessions, _, offered, _ = tables(spark, 400, seed=5)
    rnd = random.Random(6)
    names = [*rnd.sample([s[4] for s in offered], 36), "", None, "a", "zz"]
    asked = [(*AT, n, r, lang) for n in names for r in (None, *range(95, 114)) for lang in ("FR", "EN", None)]
    wants = spark.createDataFrame(asked, WANT)
    made = []
    keep = match_session.written

    def counted(df, purpose):
        out = keep(df, purpose)
        made.append(out.count())
        return out

    monkeypatch.setattr(match_session, "written", counted)
    got = match_session.scored_session(wants, sessions).collect()
    assert sum(made) < 2 * (len(asked) + len(offered))
    assert sorted(map(str, match_session.scored_session(wants, sessions, few=10**6).collect())) == sorted(map(str, got))


def test_five_thousand_titles_are_not_paired(spark, monkeypatch):
    """Of the pairs of 5,000 offers and a tenth of the wants, less than a fifth is compared before the last classes."""
    sessions, wants, *_ = tables(spark, 5000)
    wants = wants.where(F.xxhash64("title") % 10 == 0)
    made = []
    keep = match_session.written

    def counted(df, purpose):
        out = keep(df, purpose)
        if purpose == "session-nearest":
            made.append(out.count())
        return out

    monkeypatch.setattr(match_session, "written", counted)
    assert match_session.scored_session(wants, sessions).count() == wants.count()
    assert sum(made) < 5000 * wants.count() / 5


def test_narrowed_session_by_keys(spark):
    sessions, wants, offered, asked = tables(spark, 300, seed=8)
    got = {(r.title, r.runtime): r for r in match_session.narrowed_session(wants, sessions).collect()}
    low = lambda t: (t or "").lower().translate(str.maketrans("éè", "ee"))
    for want in asked:
        name, runtime = want[3], want[4]
        near = [s for s in offered if runtime is not None and s[5] is not None and abs(s[5] - runtime) <= 3]
        group = near or offered
        named = [s for s in group if low(name) and (low(name) in low(s[4]) or squished(name) in squished(s[4]))]
        group = named or group
        if len({s[7] for s in group}) > 1 and any(s[9] == "0000000001" for s in group):
            group = [s for s in group if s[9] == "0000000001"]
        assert got[(name, runtime)].session_pos == min(s[3] for s in group), want


def test_a_word_that_all_titles_share_is_no_key(spark, monkeypatch):
    """Titles of one minute, and of a day without that minute, that all hold one word: the rows of comparing all."""
    rnd = random.Random(4)
    stems = ["".join(rnd.choice("abcdefgh") for _ in range(5)) for _ in range(150)]
    make = lambda: " ".join(["film", *rnd.sample(stems, rnd.randint(1, 2))])
    offered = list(dict.fromkeys(make() for _ in range(600)))
    asked = list(dict.fromkeys([*(make() for _ in range(60)), *offered[:5], "film", "film inconnu", "rien"]))
    entry = "theater_id bigint, date string, time string, pos int, title string, url string"
    items = spark.createDataFrame([(*AT, i, t, f"u{i}") for i, t in enumerate(offered)], entry)
    wants = [(1, "2024-01-05", time, t) for t in asked for time in ("19:05", "12:00")]
    wanted = spark.createDataFrame(wants, "theater_id bigint, date string, time string, title string")
    made = []
    keep = title_keys.meeting

    def counted(*args, **kwargs):
        out = keep(*args, **kwargs)
        made.append(out.count())
        return out

    monkeypatch.setattr(title_keys, "meeting", counted)
    got = {(r.time, r.title): r for r in match_schedule.pick_near(wanted, items).collect()}
    assert made[0] < len(asked) * len(offered) / 10
    for _, _, time, t in wants:
        words, best = {w for w in t.split() if len(w) > 2}, None
        for i, o in enumerate(offered):
            share = len(words & set(o.split()))
            if time == "19:05":
                score = (300 if o == t else 200 if o.startswith(t) else 0) + share
            else:
                score = share + (100 if o.startswith(t) else 0)
            if (time == "19:05" or score) and (best is None or (-score, i) < best):
                best = (-score, i)
        r = got.get((time, t))
        assert (None if r is None else (-r.score, r.pos)) == best, (time, t)
