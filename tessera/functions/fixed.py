"""Codes and groups that results must have, stated once."""

# Fixed value: codes of titles (others: 0).
TITLE_CODES = {"Mr": 1, "Miss": 2, "Mrs": 3, "Master": 4, "Rare": 5}
# Fixed value: titles that count as rare.
RARE_TITLES = ["Lady", "Countess", "Capt", "Col", "Don", "Dr", "Major", "Rev", "Sir", "Jonkheer", "Dona"]
# Fixed value: titles that count as another.
TITLE_MERGES = {"Miss": ["Mlle", "Ms"], "Mrs": ["Mme"]}
# Fixed value: names of family sizes.
FAMILY_MAP = {1: "Alone", 2: "Small", 3: "Small", 4: "Small", 5: "Medium", 6: "Medium",
              7: "Large", 8: "Large", 11: "Large"}
# Fixed value: groups of decks.
DECK_GROUPS = {"ABC": ["A", "B", "C"], "DE": ["D", "E"], "FG": ["F", "G"]}
