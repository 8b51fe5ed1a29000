"""Entry point for spark-submit."""

from lakestrata.cli import main

if __name__ == "__main__":
    main()
