"""DataFrame-in / DataFrame-out operators: refine, summarize, inspect, quality."""
