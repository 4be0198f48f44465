"""A brute-force, pure-Python statement of the question, for small fixtures.

Written from the rules, not from the Spark code: plain loops and sorts over
lists. Sorting with mixed directions uses stable sorts applied from the
least to the most significant key.
"""

from __future__ import annotations

from collections import defaultdict


def unique_titles(titles):
    best = {}
    for item, year, title in titles:
        cur = best.get(item)
        if cur is None or year > cur[0] or (year == cur[0] and title < cur[1]):
            best[item] = (year, title)
    return best


def stats(ratings):
    acc = defaultdict(lambda: [0, 0])
    for movie, _user, rating, _date in set(ratings):
        acc[movie][0] += rating
        acc[movie][1] += 1
    return {m: (s / c, c) for m, (s, c) in acc.items()}


def top_items(ratings, titles, min_ratings, top_n, inclusive=False):
    named = unique_titles(titles)
    st = stats(ratings)
    ok = [
        m
        for m, (_avg, n) in st.items()
        if (n >= min_ratings if inclusive else n > min_ratings) and m in named
    ]
    ok.sort()  # lowest id
    ok.sort(key=lambda m: named[m][1])  # first title
    ok.sort(key=lambda m: named[m][0], reverse=True)  # newest year
    ok.sort(key=lambda m: st[m][0], reverse=True)  # best average
    return ok[:top_n]


def rated_all(ratings, items):
    items = set(items)
    movies = defaultdict(set)
    total = defaultdict(lambda: [0, 0])
    for movie, user, rating, _date in set(ratings):
        if movie in items:
            movies[user].add(movie)
            total[user][0] += rating
            total[user][1] += 1
    return {u: total[u][0] / total[u][1] for u in movies if movies[u] == items}


def contrarian_users(ratings, items, top_users):
    averages = rated_all(ratings, items)
    users = sorted(averages)
    users.sort(key=lambda u: averages[u])
    return users[:top_users]


def favourites(ratings, titles, users=None):
    named = unique_titles(titles)
    by_user = defaultdict(list)
    for row in set(ratings):
        if users is None or row[1] in users:
            by_user[row[1]].append(row)
    out = {}
    for user, rows in by_user.items():
        best = max(r[2] for r in rows)
        cands = [r for r in rows if r[2] == best and r[0] in named]
        if not cands:
            continue
        cands.sort(key=lambda r: r[0])  # lowest item id
        cands.sort(key=lambda r: r[3], reverse=True)  # latest date
        cands.sort(key=lambda r: named[r[0]][1])  # first title
        cands.sort(key=lambda r: named[r[0]][0], reverse=True)  # newest year
        movie, _u, rating, date = cands[0]
        out[user] = (movie, named[movie][1], named[movie][0], rating, date)
    return out


def report(ratings, titles, min_ratings, top_n, top_users, inclusive=False):
    top = top_items(ratings, titles, min_ratings, top_n, inclusive)
    if not top:
        return []
    users = contrarian_users(ratings, top, top_users)
    fav = favourites(ratings, titles, set(users))
    return sorted((u, f[1], f[2], f[4]) for u, f in fav.items())
