"""Rows that every document operator must survive."""

BASE = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon"
EDGE = [
    (1, "Same Text"), (2, "same text"), (2, "same text"), (3, None), (4, ""), (None, "same TEXT"), (5, "É same"), (6, "é same"),
    (7, BASE), (8, BASE + " phi"), (9, BASE.replace("kappa", "KAPPA")), (10, " \n\t "), (11, "word " * 30_000),
    (12, "a\nb\nc\nd"), (13, "x\nb\nc\ny"), (14, "b\nc"), (15, "\n\n\n"), (16, "one two three"), (17, "ONE  two three"),
]
