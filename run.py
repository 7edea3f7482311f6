"""Entry point for spark-submit: spark-submit run.py <stage> ..."""

from daymark.__main__ import main

if __name__ == "__main__":
    main()
