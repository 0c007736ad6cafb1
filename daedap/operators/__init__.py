"""The steps of the question-answering job, each from DataFrame to DataFrame."""
