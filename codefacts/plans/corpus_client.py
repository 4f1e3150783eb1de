"""Generated client sources.

Text is built by Spark from table columns, one file per row (or per bounded
chunk of rows), so the corpus grows with the tables. The DuckDB oracle never
parses: it selects the planted facts back from the same columns. Decoys
(over-long blocks, duplicate names, unknown methods, nested routes, rows
without inputs) are planted by the same column rules that the oracle states.

Placeholders ``@@col@@`` in the templates below are replaced by string
columns; all other text is literal.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from codefacts.session import cut
from codefacts.sources.tables import table

_PH = re.compile(r"@@(\w+)@@")


def fill(template: str, **cols: Column) -> Column:
    """Concatenate literal text and columns at ``@@name@@`` placeholders."""
    parts: list[Column] = []
    pos = 0
    for m in _PH.finditer(template):
        if m.start() > pos:
            parts.append(F.lit(template[pos:m.start()]))
        parts.append(F.coalesce(cols[m.group(1)].cast("string"), F.lit("")))
        pos = m.end()
    if pos < len(template):
        parts.append(F.lit(template[pos:]))
    return F.concat(*parts)


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """Spread narrow input rows over the shuffle partitions before text is generated.

    A small table is one scan split, and the text built from it is two orders
    of magnitude larger than its rows; without this every extractor downstream
    runs in one task. With ``keys`` the rows are hash-partitioned so that a
    following ``groupBy(keys)`` needs no second shuffle. An explicit count is
    kept by adaptive execution (it does not coalesce it away).

    Without ``keys`` the narrow rows are checkpointed: a filter on what an
    extractor finds would otherwise be pushed below the repartition and read the
    texts in the tasks of the scan.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(n, *keys) if keys else cut(df.repartition(n), rebalance=False)


def when_text(cond: Column, text: Column | str) -> Column:
    return F.when(cond, text if isinstance(text, Column) else F.lit(text)).otherwise(F.lit(""))


# --------------------------------------------------------------------------
# Vue components: one per part (views/P<k>.vue)
# --------------------------------------------------------------------------
COMPONENT = """<template>
  <div class="page">
    <p class="title"> @@name@@ </p>
@@role_div@@    <select v-model="form.brand">
      <option value="">all</option>
      <option value="@@brand@@"> @@ptype@@ </option>
      <option value="K@@k@@">@@name@@</option>
    </select>
    <table>
      <thead>
        <tr v-if="wide"><td>Hidden</td></tr>
        <tr><td>No</td><td> </td><td>@@ptype@@</td></tr>
      </thead>
      <tbody>
        <tr><td><span class="needs">*</span>Name</td><td><input type="text" v-model="form.name"></td></tr>
        <tr><td>Size @@z@@</td><td><input v-model="form.size" :disabled="true"></td></tr>
        <tr><td>Kind</td><td><select v-model="form.kind"><option value="@@ptype@@">@@ptype@@</option></select></td></tr>
        <tr v-for="row in rows"><td>{{ row.f@@z@@ }}</td><td>{{ row.price }}</td><td>{{ row.length }}</td></tr>
      </tbody>
    </table>
@@disabled_btn@@@@click_btn@@    <button @click="save()">Save</button>
  </div>
</template>
<script>
export default {
  name: 'Part@@k@@',
  data() {
    return { rows: [], timer: null }
  },
  created() {
    this.loadList()
    this.$store.dispatch('fetchTerm@@z@@')
  },
@@mounted@@  methods: {
@@confirm@@    loadList() {
      Client.get@@k@@(this.id).then(res => {
        this.rows = res.data
      })
      Client.legacy@@k@@()
@@branching@@    },
    save() {
      if (this.form.name === '') {
        this.$swal("이름을 입력하세요 @@k@@")
        return false
      }
      Client.get@@k@@(this.form)
      this.$swal('@@done_msg@@')
    },
    poll() {
      this.timer = setInterval(() => {
        Client.status@@k@@(this.id).then(res => {
          if (res.data.isRegistrationDone == true) {
            clearInterval(this.timer)
          }
        })
        this.refresh()
      }, @@delay@@)
    }
  }
}
</script>
"""

ROLE_DIV = """    <div v-if="role === 'admin'">Admin</div>\n"""
DISABLED_BTN = """    <button :disabled="status === 'FINISHED'">Close</button>\n"""
CLICK_BTN = """    <button @click="semester === 'SPRING' ? loadSpring() : loadFall()">Go</button>\n"""
MOUNTED = """  mounted() {\n    this.poll()\n  },\n"""
CONFIRM = """    finish() {
      this.$swal({
        input: 'text',
        inputValidator: (value) => {
          if (value !== "종료합니다 @@k@@") {
            return '정확히 입력하세요'
          }
        }
      }).then(r => { Client.finish@@k@@(this.id) })
    },
    // ------------------------------------------------------------------------------------------------------------------------------------------------------------------------------------------------------------------------
"""
BRANCHING = """      const fn = this.type === 'A' ? listA() : listB()
      if (this.semester === 'FALL') {
        Client.fall@@k@@()
      } else {
        this.loadList()
      }
"""

# done message by p_size % 3: success / error / info words
DONE_MESSAGES = ("저장되었습니다", "서버 오류입니다", "확인해 주세요")


def component_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(path, content)``: one component per ``part`` row.

    Planted facts (k = p_partkey, z = p_size): title p_name; options
    (p_brand, p_type) and (K<k>, p_name) plus (p_type, p_type) in a form select;
    header columns [No, p_type]; three form fields; list field f<z>; disabled
    guard when z % 3 = 0; a role-guarded block when z % 5 = 0; template
    ternary when z % 4 = 0; mounted hook when
    z % 2 = 0; confirmation guard when z % 7 = 0; script ternary and if/else
    when z % 6 = 0; poll delay z * 100.
    """
    p = spread(table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type", "p_size"))
    k, z = F.col("p_partkey"), F.col("p_size")
    cols = dict(k=k, z=z, name=F.col("p_name"), brand=F.col("p_brand"), ptype=F.col("p_type"),
                delay=z * 100,
                done_msg=F.element_at(F.array(*[F.lit(m) for m in DONE_MESSAGES]), (z % 3 + 1).cast("int")),
                disabled_btn=when_text(z % 3 == 0, DISABLED_BTN),
                role_div=when_text(z % 5 == 0, ROLE_DIV),
                click_btn=when_text(z % 4 == 0, CLICK_BTN),
                mounted=when_text(z % 2 == 0, MOUNTED),
                confirm=when_text(z % 7 == 0, fill(CONFIRM, k=k)),
                branching=when_text(z % 6 == 0, fill(BRANCHING, k=k)))
    return p.select(F.concat(F.lit("views/P"), k.cast("string"), F.lit(".vue")).alias("path"),
                    fill(COMPONENT, **cols).alias("content"))


# --------------------------------------------------------------------------
# API client: one file per part (api/p<k>.js)
# --------------------------------------------------------------------------
API_FILE = """import axios from 'axios'

class Client {
  constructor(base) {
    this.base = base
  }
@@dup@@
  async get@@k@@(id, opts) {
    if (opts) {
      console.log(opts)
    }
@@pad@@@@call@@
  }

  status@@k@@(id) {
    return axios.post(`/api/v1/status/${id}`)
  }
}
"""
API_DUP = """
  get@@k@@(id) {
    return axios.put('/old/@@k@@')
  }
"""
API_CALL = """    const res = await axios.@@verb@@('/api/v1/@@seg@@/@@k@@', { id })
    return res.data"""
API_RETURN = """    return `${this.base}/api/v1/file/${id}/@@k@@`"""
API_PAD = "    // " + "=" * 200_000 + "\n"
VERBS = ("get", "post", "put")


def api_client_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(path, content)``: one API client per ``part`` row.

    ``get<k>``: verb by k % 4 (get, post, put; 3 = returned URL, GET with
    ``:param``); an earlier duplicate (PUT /old/<k>) when k % 11 = 0, which loses; a
    very long body when k % 97 = 0. ``status<k>`` posts a
    template URL that stays raw (SURVEY Q17).
    """
    p = spread(table(spark, sf_dir, "part").select("p_partkey", "p_type"))
    k = F.col("p_partkey")
    verb = F.element_at(F.array(*[F.lit(v) for v in VERBS]), (k % 4 + 1).cast("int"))
    call = F.when(k % 4 == 3, fill(API_RETURN, k=k)).otherwise(
        fill(API_CALL, verb=verb, seg=F.lower("p_type"), k=k))
    return p.select(F.concat(F.lit("api/p"), k.cast("string"), F.lit(".js")).alias("path"),
                    fill(API_FILE, k=k, call=call, dup=when_text(k % 11 == 0, fill(API_DUP, k=k)),
                         pad=when_text(k % 97 == 0, API_PAD)).alias("content"))


# --------------------------------------------------------------------------
# Routers: one file per (s_nationkey, s_suppkey div 64)
# --------------------------------------------------------------------------
ROUTE = """  {
    path: '/s@@s@@',
    name: 'S@@s@@',
    component: () => import('@/views/P@@s@@.vue'),
    meta: { @@auth@@needsPermission: @@mask@@@@grad@@ },
@@children@@  },
"""
ROUTE_CHILD = """    children: [
      { path: 'detail', component: () => import('@/views/D@@s@@.vue') }
    ],
"""


def router_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(path, content)``: routes of at most 64 suppliers per file.

    Per supplier s: path /s<s>, name S<s>, component views/P<s>.vue, mask
    s % 16, requireAuth when s is even, needsGraduated when s % 3 = 0,
    needsNotGraduated when s % 3 = 1, a nested child route when s % 5 = 0.
    """
    s_ = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    s = F.col("s_suppkey")
    route = fill(ROUTE, s=s, mask=s % 16,
                 auth=when_text(s % 2 == 0, "requireAuth: true, "),
                 grad=F.when(s % 3 == 0, F.lit(", needsGraduated: true"))
                 .when(s % 3 == 1, F.lit(", needsNotGraduated: true")).otherwise(F.lit("")),
                 children=when_text(s % 5 == 0, fill(ROUTE_CHILD, s=s)))
    chunk = F.floor(s / 64)
    files = (spread(s_.select(F.col("s_nationkey").alias("n"), chunk.alias("c"), s.alias("s"), route.alias("r")),
                    "n", "c")
             .groupBy("n", "c")
             .agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("s", "r"))),
                                           lambda x: x["r"]), "").alias("body")))
    return files.select(F.concat(F.lit("router/n"), F.col("n").cast("string"), F.lit("_"),
                                 F.col("c").cast("string"), F.lit(".js")).alias("path"),
                        F.concat(F.lit("const routes = [\n"), F.col("body"), F.lit("]\n")).alias("content"))


# --------------------------------------------------------------------------
# Stores and translators: one file per (c_nationkey, c_custkey div 64)
# --------------------------------------------------------------------------
STORE_GETTER = """    seg@@c@@(state) {
      if (state.segment === '@@mkt@@') {
        return state.term
      }
      return null
    },
"""
STORE_PLAIN_GETTER = """    all@@c@@(state) {
      return state.items
    },
"""
STORE_ACTION = """    async load@@c@@({ commit }, id) {
      const res = await Client.get@@c@@(id)
      commit('set', res)
    },
"""
STORE_EMPTY_ACTION = """    reset@@c@@({ commit }) {
      commit('reset')
    },
"""
STORE_FILE = """export default new Vuex.Store({
  state: {
    isLogin: false,
    sessionID: '',
    user: null,
    term@@n@@: null,
    segment@@n@@: ''
  },
  getters: {
@@getters@@@@plain@@  },
  actions: {
    login({ commit }, creds) {
      Client.login(creds)
    },
@@actions@@  }
})
"""
TRANSLATOR_BLOCK = """Vue.prototype.$seg@@c@@ = function (v) {
  switch (v) {
    case "@@mkt@@":
      return "@@name@@"
    case 'N@@n@@':
      return 'nation @@n@@'
  }
}

"""


def _customer_chunks(spark: SparkSession, sf_dir: str, pieces: dict) -> DataFrame:
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    ck = F.col("c_custkey")
    cols = [F.col("c_nationkey").alias("n"), F.floor(ck / 64).alias("ch"), ck.alias("c")]
    cols += [v.alias(k) for k, v in pieces.items()]
    def field(name):
        return lambda x: x[name]

    g = spread(c.select(*cols), "n", "ch").groupBy("n", "ch").agg(
        *[F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("c", k))), field(k)), "")
          .alias(k) for k in pieces])
    return g


def store_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(path, content)``: per customer c a filtering getter ``seg<c>`` (on
    c_mktsegment) unless c % 3 = 0, then a plain getter ``all<c>`` after all
    filtering ones; an action ``load<c>`` calling ``Client.get<c>`` unless
    c % 4 = 0 (``reset<c>`` without calls); a skipped ``login`` action; state
    fields term<n>, segment<n> besides three skipped names."""
    ck = F.col("c_custkey")
    g = _customer_chunks(spark, sf_dir, {
        "getters": when_text(ck % 3 != 0, fill(STORE_GETTER, c=ck, mkt=F.col("c_mktsegment"))),
        "plain": when_text(ck % 3 == 0, fill(STORE_PLAIN_GETTER, c=ck)),
        "actions": F.when(ck % 4 != 0, fill(STORE_ACTION, c=ck)).otherwise(fill(STORE_EMPTY_ACTION, c=ck))})
    return g.select(F.concat(F.lit("store/n"), F.col("n").cast("string"), F.lit("_"), F.col("ch").cast("string"),
                             F.lit(".js")).alias("path"),
                    fill(STORE_FILE, n=F.col("n"), getters=F.col("getters"), plain=F.col("plain"),
                         actions=F.col("actions")).alias("content"))


def translator_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(path, content)``: per customer c a prototype function ``seg<c>`` with
    cases c_mktsegment -> c_name and N<nation> -> ``nation <nation>``."""
    ck = F.col("c_custkey")
    g = _customer_chunks(spark, sf_dir, {
        "blocks": fill(TRANSLATOR_BLOCK, c=ck, mkt=F.col("c_mktsegment"), name=F.col("c_name"),
                       n=F.col("c_nationkey"))})
    return g.select(F.concat(F.lit("plugins/n"), F.col("n").cast("string"), F.lit("_"), F.col("ch").cast("string"),
                             F.lit(".js")).alias("path"),
                    F.concat(F.lit("import Vue from 'vue'\n\n"), F.col("blocks")).alias("content"))
