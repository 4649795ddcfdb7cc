"""The same results kept up to date as changes arrive."""
