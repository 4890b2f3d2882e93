"""The registered check queries: each a Spark query and, where SQL can say it, its oracle."""
