"""``python -m asklens graph|ratings|stream ...``: the job entry points of ``asklens.apps``."""

from asklens.apps import main

if __name__ == "__main__":
    main()
