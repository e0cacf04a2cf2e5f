"""Where pages, questions and answers come from."""
