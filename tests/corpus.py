"""The hand-worked corpus: doc_id, title, content, categories."""

CORPUS = [
    (0, "Red River", "The red river, a river in the north.", ["Rivers", "North"]),
    (1, "River Red Gum", "A red-barked tree near the river; don't cut.", ["Trees"]),
    (2, "The Red", "Red. red? RED!", ["Colors of art", "North"]),
    (3, "Café", "-- café …", ["Places"]),
]
