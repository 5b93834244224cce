"""Training-data operators (sharding, token counts, decontamination,
packing, line dedup, quality, n-gram Jaccard join, toxicity, substring
dedup, exact top-k search, importance resampling, line frequency rules,
filter interaction audit). Nothing else in the library imports this
subpackage; ``queries`` holds the registered queries and their SQL."""
