"""DataFrame operators: Silver (parse, rules, dedup), Gold (aggregates, top-k), quality gate."""
