"""Analytics over large daily name lists and web-link graphs, written as Spark DataFrame transformations."""
