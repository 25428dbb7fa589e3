from llm_support import no_docs, odd_docs  # noqa: F401
