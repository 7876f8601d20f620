"""Small brute-force statistics to test against."""


def average_ranks(values):
    order = sorted(values)
    return [order.index(v) + (order.count(v) + 1) / 2 for v in values]


def pearson(x, y):
    mx, my = sum(x) / len(x), sum(y) / len(y)
    cov = sum((a - mx) * (b - my) for a, b in zip(x, y))
    return cov / (sum((a - mx) ** 2 for a in x) * sum((b - my) ** 2 for b in y)) ** 0.5
