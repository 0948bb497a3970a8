"""Script for spark-submit: runs one step of the complaint data set."""

from lavra.jobs import main

if __name__ == "__main__":
    main()
